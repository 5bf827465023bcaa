"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied for each page and language:

* the text: hashed character trigrams under a multinomial model with Dirichlet smoothing, tempered, since trigrams of
  one page are far from independent;
* the declared markup language: how often pages of a language declare it, counted over all pages;
* the address suffix and the host: a prior that shrinks the host's own counts towards its suffix's, and those towards
  the corpus, so a host with few pages speaks with the voice of its suffix.

The counts are sums of the pages' text posteriors, formed by grouped aggregation (a host with a third of all pages is
one row of sums for each map task), and a page's own part is taken out of them before they judge it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_slices, sample_cut, stored

BUCKETS = 1 << 13
#: Characters that all trigrams together count for at most; what is above is tempered away.
TEMPER = 60.0
#: Pseudo-counts: of the parent's prior in a child, and of every cell of the declaration table.
SHRINK, CELL = 4.0, 0.5

#: Elements whose content is not text, and how each ends.
_DROP = re.compile(r"(?i)<!--|<(?:script|style|template|noscript)\b")
_ENDS = {"<!--": re.compile("-->"), **{f"<{name}": re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "template", "noscript")}}
#: Numbers of characters: ``html.unescape`` takes no number of thousands of digits.
_ZEROS, _LONG_NUMBER = re.compile("&#0+(?=[0-9])"), re.compile("&#[0-9]{8,};?")
_HTML, _LANG = re.compile(r"(?i)<html\b"), re.compile(r"""(?i)\slang\s*=\s*["']?([A-Za-z]{2,8})""")
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")


def _without(page: str, opens: Callable[[int], tuple[int, int] | None]) -> str:
    """The page with a space for each span that ``opens`` finds from a place on."""
    out, at = [], 0
    while span := opens(at):
        out += [page[at : span[0]], " "]
        at = span[1]
    return "".join([*out, page[at:]])


def visible_text(page: str) -> str:
    """The text of a page without tags, scripts, styles and comments, in time linear in its length.

    An element that doesn't end is not left out, but its tag is; a ``<`` with no ``>`` behind it is text.
    """
    endless: set[str] = set()

    def element(at: int) -> tuple[int, int] | None:
        while start := _DROP.search(page, at):
            kind = start[0].lower()
            end = None if kind in endless else _ENDS[kind].search(page, start.end())
            if end:
                return start.start(), end.end()
            endless.add(kind)
            at = start.end()
        return None

    bare = _without(page, element)

    def tag(at: int) -> tuple[int, int] | None:
        start = bare.find("<", at)
        end = bare.find(">", start) if start >= 0 else -1
        return (start, end + 1) if end >= 0 else None

    return html.unescape(_LONG_NUMBER.sub("\ufffd", _ZEROS.sub("&#", _without(bare, tag))))


def declared_language(page: str) -> str | None:
    """The main part of the language that the first html tag names."""
    start = _HTML.search(page)
    if not start:
        return None
    end = page.find(">", start.end())
    found = _LANG.search(page, start.end(), end if end >= 0 else len(page))
    return found[1].lower() if found else None


def host_of(url: str) -> str | None:
    found = _HOST.match(url.strip())
    return found[1].lower().rstrip(".") or None if found else None


def trigram_counts(text: str) -> np.ndarray:
    """Counts of hashed character trigrams of letters and spaces, upper and lower case alike."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    letter = (codes > 127) | ((codes >= 97) & (codes <= 122))
    codes = np.where(letter, codes, np.uint64(32))
    codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
    if len(codes) < 3:
        return np.zeros(BUCKETS, np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    mixed ^= mixed >> np.uint64(15)
    return np.bincount((mixed * np.uint64(0x2C1B3C6D) >> np.uint64(7)) & np.uint64(BUCKETS - 1), minlength=BUCKETS)


def fit_text_model(texts: DataFrame, max_rows: int = 4000, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (language, bucket) from at most ``max_rows`` distinct labelled rows.

    The rows are the first by a hash of id, language and text; those without language or text are no labels. Hashes
    are cut first, so texts of the sample alone travel and are counted where they are. The model's size is the number
    of languages in the sample times the buckets. No labels give no languages.
    """
    rows = texts.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, lang_col, text_col).alias("h"), F.col(text_col).alias("text"))
    cut = sample_cut(rows, "h", max_rows)
    if cut is None:
        return [], np.zeros((0, BUCKETS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[lang] = sums.get(lang, 0) + trigram_counts(text)
            for lang, counts in sums.items():
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int64()), pa.array(counts[there], pa.int64())], names=["lang", "bucket", "n"])

    sample = rows.where(F.col("h") <= cut).dropDuplicates(["h"]).select("lang", "text")
    found: dict[str, np.ndarray] = {}
    for row in sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        found.setdefault(row["lang"], np.zeros(BUCKETS, np.int64))[row["bucket"]] = row["n"]
    langs = sorted(found)
    table = np.array([found[x] for x in langs], float) + 0.1
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def page_evidence(pages: DataFrame, langs: list[str], model: np.ndarray, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """id, host, suffix, declared language and text posterior of each page."""
    source = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded: languages of the sample times BUCKETS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in in_slices(batches):
            hosts, declared, scores = [], [], []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hosts.append(host_of(url or ""))
                declared.append(declared_language(page or ""))
                counts = trigram_counts(visible_text(page or ""))
                total = counts.sum()
                score = weights @ counts * (min(1.0, TEMPER / total) if total else 0.0)
                likely = np.exp(score - score.max())
                scores.append((likely / likely.sum()).tolist())
            suffixes = [h.rpartition(".")[2] if h else None for h in hosts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in (hosts, suffixes, declared)), pa.array(scores, pa.list_(pa.float64()))], names=[id_col, "host", "suffix", "declared", "text_posterior"])

    schema = source.select(id_col).withColumns({"host": F.lit(None).cast("string"), "suffix": F.lit(None).cast("string"), "declared": F.lit(None).cast("string"), "text_posterior": F.array(F.lit(0.0))}).schema
    return source.mapInArrow(read, schema)


def _sums(table: DataFrame, key: str, n: int) -> DataFrame:
    sums = table.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(F.get("text_posterior", F.lit(i))).alias(f"_p{i}") for i in range(n)])
    return sums.select(F.col(key).alias(f"_{key}_key"), F.array(*[f"_p{i}" for i in range(n)]).alias(f"{key}_sums"))


def identify_languages(pages: DataFrame, labelled: DataFrame, max_rows: int = 4000, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """The language of each page: id, host, suffix, declared, text_lang, lang, probability and all posteriors.

    The text model is fitted on at most ``max_rows`` of ``labelled`` (doc_id, text, lang). A page without text is
    judged by its address and declaration alone; a null address or declaration gives no evidence of its kind. Ties go
    to the first language in alphabetical order. Repeated pages are judged alike, an empty table gives no rows, and
    without any label ``lang`` is null. Pages are read whole, in time linear in their length. Columns but the three
    named are never read, whatever they are called.
    """
    langs, model = fit_text_model(labelled, max_rows)
    if not langs:
        bare = pages.select(F.col(id_col))
        return bare.withColumns({c: F.lit(None).cast("string") for c in ("host", "suffix", "declared", "text_lang", "lang")}).withColumn("probability", F.lit(None).cast("double")).withColumn("posterior", F.array().cast("array<double>"))
    n = len(langs)
    names = F.array(*[F.lit(x) for x in langs])
    table = stored(page_evidence(pages, langs, model, url_col, html_col, id_col), "page-evidence", texts=True)
    # n numbers for the corpus; grouped sums come back by joins that may be split.
    corpus = table.agg(*[F.coalesce(F.sum(F.get("text_posterior", F.lit(i))), F.lit(0.0)) for i in range(n)]).first()
    joined = table.withColumn("corpus", F.array(*[F.lit(float(x)) for x in corpus]))
    for key in ("suffix", "host", "declared"):
        joined = joined.join(_sums(table, key, n), F.col(key) == F.col(f"_{key}_key"), "left")

    own = F.col("text_posterior")

    def without_own(sums: Column) -> Column:
        """The sums less the page's own part, never under zero; zeros where there are none."""
        return F.when(sums.isNull(), F.array_repeat(F.lit(0.0), n)).otherwise(F.zip_with(sums, own, lambda s, p: F.greatest(F.lit(0.0), s - p)))

    def shrunk(sums: Column, parent: Column) -> Column:
        total = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(sums, parent, lambda s, p: (s + SHRINK * p) / (total + SHRINK))

    flat = F.array_repeat(F.lit(1.0 / n), n)
    with_prior = joined.withColumn("_corpus", shrunk(without_own(F.col("corpus")), flat)).withColumn("_suffix", shrunk(without_own(F.col("suffix_sums")), F.col("_corpus"))).withColumn("_prior", shrunk(without_own(F.col("host_sums")), F.col("_suffix")))
    # P(declared | language): the declaration's sums over the corpus's.
    declared = F.when(F.col("declared").isNull(), F.array_repeat(F.lit(1.0), n)).otherwise(F.zip_with(without_own(F.col("declared_sums")), without_own(F.col("corpus")), lambda d, c: (d + CELL) / (c + 2 * CELL)))
    product = F.transform(F.arrays_zip(own.alias("t"), declared.alias("d"), F.col("_prior").alias("p")), lambda x: x["t"] * x["d"] * x["p"])
    scored = with_prior.withColumn("_joint", product).withColumn("_sum", F.aggregate("_joint", F.lit(0.0), lambda a, x: a + x))
    fused = scored.withColumn("posterior", F.transform("_joint", lambda x: F.when(F.col("_sum") > 0, x / F.col("_sum")).otherwise(1.0 / n)))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return fused.select(id_col, "host", "suffix", "declared", best(own).alias("text_lang"), best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"), "posterior")
