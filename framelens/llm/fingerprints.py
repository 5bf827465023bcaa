"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A text is the multiset of its paragraphs: it is cut after line breaks, and since many texts are a single line, lines are
cut after the end of a sentence or a table cell and after five words, with nothing left out. Each part is hashed into a
wide vector and the vectors are added, every lane modulo 2**32, so the order of the parts doesn't matter and parts can
be inserted or deleted later by adding or subtracting their vectors. A vector has

* one lane that counts the parts,
* ``EXACT`` lanes of independent 32-bit hashes: equal multisets are equal there, others practically never,
* ``SKETCH`` lanes, to each of which a part adds a bit of its hash. Taken as signs, they are a random projection of
  the multiset, so the product of two sums estimates how many parts two texts share.

No text has 2**32 parts, so neither the count nor a sketch lane of a text ever wraps.

Only SQL functions: parts are exploded and summed by a hash aggregate that is partitioned by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import order_id, ranged, stored, text_of

EXACT = 16
SKETCH = 128
#: A part: up to five words with the white-space character behind each. It ends early after a line break, a sentence end
#: or a cell mark.
PART = r"(?:\S*[^\s.!?|;][^\S\n]){0,4}\S*\s?"
LANE = 0xFFFFFFFF
EACH_HALF = 0x0000000100000001


def parts_of(text: Column) -> Column:
    """The parts of a text in order; together they are the text. The empty text has none."""
    return F.filter(F.regexp_extract_all(text, F.lit(PART), F.lit(0)), lambda p: F.length(p) > 0)


def _lane_sums(part: Column) -> list[Column]:
    """Sums over exploded parts (null: no part). A long holds one lane or, in two halves that never meet, two."""
    there = part.isNotNull()
    add = lambda c: F.coalesce(F.sum(F.when(there, c)), F.lit(0))
    sums = [F.count(part)]
    for seed in range(EXACT // 2):
        h = F.xxhash64(part, F.lit(seed))
        sums += [add(h.bitwiseAND(F.lit(LANE))), add(F.shiftrightunsigned(h, 32))]
    for seed in range(SKETCH // 64):
        h = F.xxhash64(part, F.lit(1000 + seed))
        sums += [add(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(EACH_HALF))) for j in range(32)]
    return sums


def _lanes(sums: list[Column]) -> Column:
    halves = [x for s in sums[1 + EXACT :] for x in (s, F.shiftrightunsigned(s, 32))]
    return F.array(*[x.bitwiseAND(F.lit(LANE)) for x in (*sums[: 1 + EXACT], *halves)])


def _signed(x: Column, bits: int) -> Column:
    """The low bits of a number as a signed one, which fits a narrow type."""
    sign = F.lit(1 << (bits - 1))
    return x.bitwiseAND(F.lit((1 << bits) - 1)).bitwiseXOR(sign) - sign


def _narrow(lanes: Column) -> Column:
    """Lanes for a shuffle: exact ones in four bytes, sketch ones in two, and their upper halves, mostly zeros, apart."""
    exact = F.transform(F.slice(lanes, 1, 1 + EXACT), lambda x: _signed(x, 32).cast("int"))
    sketch = F.slice(lanes, EXACT + 2, SKETCH)
    low = F.transform(sketch, lambda x: _signed(x, 16).cast("short"))
    high = F.transform(sketch, lambda x: _signed(F.shiftright(x, 16), 16).cast("short"))
    return F.struct(exact.alias("exact"), low.alias("low"), high.alias("high"))


def _widen(narrow: Column) -> Column:
    exact = F.transform(narrow["exact"], lambda x: x.cast("long").bitwiseAND(F.lit(LANE)))
    half = lambda x: x.cast("long").bitwiseAND(F.lit(0xFFFF))
    return F.concat(exact, F.zip_with(narrow["low"], narrow["high"], lambda x, y: half(x) + F.shiftleft(half(y), 16)))


def fingerprint_texts(texts: DataFrame, keys: list[str], text_col: str = "text", into: str = "lanes") -> DataFrame:
    """``keys`` and the vector (array of longs) of the multiset of all parts of the rows with these keys."""
    rows = texts.select(*keys, F.explode_outer(parts_of(text_of(text_col))).alias("_part"))
    names = [f"_s{i}" for i in range(1 + EXACT + SKETCH // 2)]
    summed = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in zip(names, _lane_sums(F.col("_part")))])
    return summed.select(*keys, _lanes([F.col(n) for n in names]).alias(into))


def add(a: Column, b: Column) -> Column:
    """The vector of the union of two multisets: what inserting ``b`` gives."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(LANE)))


def subtract(a: Column, b: Column) -> Column:
    """The vector that is left after deleting the parts of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(LANE)))


def digest(lanes: Column) -> Column:
    """A vector as fixed-width lowercase hex."""
    return F.lower(F.array_join(F.transform(lanes, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the estimated shared mass 2ab / (aa + bb) of two vectors. 1 for equal ones, empty texts included.

    Only the count and the sketch lanes are read, those after the first ``1 + EXACT`` lanes.
    """
    signed = lambda x, n: (2 * x - n).cast("double")
    pairs = F.zip_with(F.slice(a, EXACT + 2, SKETCH), F.slice(b, EXACT + 2, SKETCH), lambda x, y: F.struct(signed(x, F.get(a, F.lit(0))).alias("x"), signed(y, F.get(b, F.lit(0))).alias("y")))
    start = F.struct(F.lit(0.0).alias("both"), F.lit(0.0).alias("own"))
    sums = F.aggregate(pairs, start, lambda acc, p: F.struct((acc["both"] + p["x"] * p["y"]).alias("both"), (acc["own"] + (p["x"] * p["x"] + p["y"] * p["y"])).alias("own")))
    return F.when(sums["own"] == 0, F.when(F.get(a, F.lit(0)) == F.get(b, F.lit(0)), 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), 2.0 * sums["both"] / sums["own"]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that share id and text share a key."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).isNotNull().alias("_known"), order_id(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


KEY = ["_known", "_id", "_hash"]


def following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each distinct (id, text): its length, number of rows and the key of the next in descending order, after the last the first.

    The order is found by ranges: a window in each, and one over the last row of every range.
    """
    keyed = _keyed(docs, id_col, text_col)
    own = keyed.select(*KEY, F.length("_text").alias("_n")).groupBy(*KEY).agg(F.max("_n").alias("_n"), F.count("*").alias("_copies"))
    parts = ranged(own, *KEY, label="order")
    key = F.struct(*KEY)
    ends = parts.groupBy("_range").agg(F.max(key).alias("_end"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edges = ends.select("_range", F.last("_end").over(before).alias("_edge"), F.max("_end").over(Window.partitionBy()).alias("_top"))
    inside = Window.partitionBy("_range").orderBy(*KEY)
    # A row for each range: bounded by the number of shuffle partitions.
    linked = parts.withColumn("_next", F.lag(key).over(inside)).join(F.broadcast(edges), "_range")
    return linked.select(*KEY, "_n", "_copies", F.coalesce("_next", "_edge", "_top").alias("_next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Vectors of each text, of its edited text and their likeness, and its likeness to the next document.

    The edited text ends in the start of the next document in descending order of ids: its last third, rounded down,
    is replaced by as many code points of that one, or all it has. Returns id, ``n_chars``, ``edited_text_sha256``,
    ``lanes``, ``edited_lanes``, ``near_edited`` and ``near_next``.

    A null text is empty; a very long one is read whole. A null id comes last in that order. Rows with the same id and
    text are one document here and each gets an output row; they collapse before they are shuffled. The same id with
    several texts is ordered by a hash of the text. A single document is its own next, and an empty table gives no
    rows. Columns but those two are never read. The texts are shuffled once and the borrowed starts once.
    """
    base = _keyed(docs, id_col, text_col).groupBy(*KEY).agg(F.first("_text").alias("_text"))
    order = stored(following(docs, id_col, text_col), "following")
    wanted = order.select(*[F.col("_next")[k].alias(k) for k in KEY], *[F.col(k).alias(f"_for{k}") for k in KEY], F.expr("cast(_n div 3 as int)").alias("_take"))
    # Each document follows one other, so both joins keep one row a key.
    given = base.join(wanted, KEY).select(*[F.col(f"_for{k}").alias(k) for k in KEY], F.expr("substring(_text, 1, _take)").alias("_lent"))
    kept = F.expr("substring(_text, 1, cast(length(_text) - length(_text) div 3 as int))")
    edited = base.join(given, KEY).select(*KEY, "_text", F.concat(kept, "_lent").alias("_edited")).withColumn("_sha", F.sha2("_edited", 256))
    versions = edited.select(*KEY, "_sha", F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("v"), F.col("_edited").alias("t")))).alias("_x"))
    parts = versions.select(*KEY, "_sha", F.col("_x")["v"].alias("_v"), F.explode_outer(parts_of(F.col("_x")["t"])).alias("_part"))
    names = [f"_s{i}" for i in range(1 + EXACT + SKETCH // 2)]
    # The join has dealt the rows by key, so these aggregates need no exchange.
    sums = parts.groupBy(*KEY, "_sha", "_v").agg(*[c.alias(n) for n, c in zip(names, _lane_sums(F.col("_part")))])
    vectors = sums.select(*KEY, "_sha", "_v", _narrow(_lanes([F.col(n) for n in names])).alias("_lanes"))
    of_version = lambda v: F.first(F.when(F.col("_v") == v, F.col("_lanes")), ignorenulls=True)
    pairs = vectors.groupBy(*KEY, "_sha").agg(of_version(0).alias("_own"), of_version(1).alias("_new"))
    own = stored(pairs.join(order, KEY), "vectors")
    # The likeness reads no exact lanes, so none but the count travel to the document before.
    sketch = F.struct(F.slice("_own.exact", 1, 1).alias("exact"), "_own.low", "_own.high")
    after = own.select(*[F.col(k).alias(f"_at{k}") for k in KEY], sketch.alias("_following"))
    linked = own.join(after, [F.col("_next")[k] == F.col(f"_at{k}") for k in KEY])
    padded = F.struct(F.concat(F.col("_following.exact"), F.array_repeat(F.lit(0), EXACT)).alias("exact"), "_following.low", "_following.high")
    linked = linked.withColumns({"_own": _widen(F.col("_own")), "_new": _widen(F.col("_new")), "_following": _widen(padded)})
    each = linked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return each.select(
        F.when(F.col("_known"), F.col("_id")).alias(id_col),
        F.col("_n").cast("long").alias("n_chars"),
        F.col("_sha").alias("edited_text_sha256"),
        F.col("_own").alias("lanes"),
        F.col("_new").alias("edited_lanes"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"),
    )
