"""Matching and average precision in SQL, over any table of pairs.

``pairs`` has image, cls, det, conf, gt and iou; beside it stand ``det`` (image, cls, det, conf) and ``gt`` (image, cls, gt).
"""

from __future__ import annotations

MATCHES = """levels AS (SELECT pairs.*, t.threshold FROM pairs JOIN (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) t(threshold) ON iou >= t.threshold),
once AS (SELECT * FROM levels QUALIFY row_number() OVER (PARTITION BY image, threshold, det ORDER BY iou DESC, gt) = 1),
matches AS (SELECT image, cls, threshold, det, gt, iou FROM once QUALIFY row_number() OVER (PARTITION BY image, threshold, gt ORDER BY det) = 1)"""

_CURVE = """n AS (SELECT cls, count(*) AS n FROM gt GROUP BY cls), lv(threshold) AS (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)),
hit AS (SELECT d.cls, lv.threshold, d.image, d.det, d.conf, (m.det IS NOT NULL)::INT AS tp FROM det d CROSS JOIN lv LEFT JOIN matches m ON m.image = d.image AND m.det = d.det AND m.threshold = lv.threshold),
run AS (SELECT cls, threshold, row_number() OVER w AS k, sum(tp) OVER w AS c FROM hit WINDOW w AS (PARTITION BY cls, threshold ORDER BY conf DESC, image, det)),
pr AS (SELECT cls, threshold, k, c::DOUBLE / n AS r, c::DOUBLE / k AS p FROM run JOIN n USING (cls)),
marked AS (
  SELECT * FROM pr
  UNION ALL SELECT cls, threshold, 0, 0.0, 1.0 FROM n CROSS JOIN lv
  UNION ALL SELECT cls, threshold, max(k) + 1, max(r), 0.0 FROM pr GROUP BY 1, 2
  UNION ALL SELECT cls, threshold, max(k) + 2, 1.0, 0.0 FROM pr GROUP BY 1, 2),
env AS (SELECT *, max(p) OVER (PARTITION BY cls, threshold ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM marked),
nxt AS (SELECT *, lead(r) OVER w AS r2, lead(e) OVER w AS e2 FROM env WINDOW w AS (PARTITION BY cls, threshold ORDER BY k)),
seg AS (SELECT * FROM nxt WHERE r2 > r),
grid AS (SELECT cls, threshold, i, e + (e2 - e) / (r2 - r) * (i * 0.01::DOUBLE - r) AS y FROM seg JOIN range(0, 100) t(i) ON i * 0.01::DOUBLE >= r AND i * 0.01::DOUBLE < r2)
SELECT n.cls, lv.threshold, n.n AS n_truth, round(coalesce((SELECT sum(y * CASE WHEN i = 0 THEN 0.005::DOUBLE ELSE 0.01::DOUBLE END) FROM grid g WHERE g.cls = n.cls AND g.threshold = lv.threshold), 0), 6) AS ap FROM n CROSS JOIN lv"""


def average_precision(pairs: str) -> str:
    return f"WITH {pairs}, {MATCHES}, {_CURVE}"
