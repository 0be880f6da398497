"""Benchmark decontamination: a broadcast hash set of test n-grams over training token windows.

Everything on the main path is DataFrame expressions. Per document, inside one projection:
words -> 64-bit word hashes -> a hash of three words of every window (first, middle, last) ->
membership in a bit filter over the benchmark's windows. Only positions that pass carry their
13 words on, to be verified by a broadcast hash join with the windows themselves. Clean text is
never exploded or shuffled; what is shuffled are ids, counts and hits.

The windows are broadcast only while there are at most ``max_broadcast_windows``; a larger
benchmark takes the same plan with every window position exploded into a shuffled join. There a
window travels as two 64-bit hashes of its words under different seeds, 16 bytes that stand for the
text; the benchmark's windows are written first, so that two plain scans meet and a window that very
many documents hold is split at run time.

Defined cases: null or wordless text has 0 words, 0 hits and is clean; an item without words has
no window; repeated rows are judged one by one; an empty benchmark leaves every document clean, an empty
table gives no rows; very long texts are judged whole; null ids are ids like any other; of the columns of
docs only id and text are read, so that none clashes; items that share a window all count.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.store import materialize
from .common import let, lower_ascii, row_key

#: Words after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SECOND_SEED = 0x5EED
#: A document is contaminated if hits * RATIO >= words.
RATIO = 20
#: 100,000 windows of 13 words are about 10 MB as a broadcast relation, 400 KB as a bit filter.
MAX_BROADCAST_WINDOWS = 100_000
#: Contaminated rows of which ids and keys are broadcast (about 20 MB).
BROADCAST_ROWS = 500_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(gram, len, anchor, items): the distinct windows, their three-word hash, the items they occur in."""
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("ws"))
    b = b.filter((F.size("ws") > 0) & F.col("item").isNotNull())
    n = F.least(F.lit(window), F.size("ws"))
    b = b.select("item", "ws", n.alias("len"), F.explode(F.sequence(F.lit(1), F.size("ws") - n + 1)).alias("at"))
    b = b.select("item", "len", F.slice("ws", F.col("at"), F.col("len")).alias("g"))
    h = lambda k: F.xxhash64(F.get("g", k))
    anchor = F.when(F.col("len") == window, F.xxhash64(h(F.lit(0)), h(F.lit(window // 2)), h(F.lit(window - 1)))).otherwise(h(F.lit(0)))
    b = b.select("item", "len", F.array_join("g", " ").alias("gram"), anchor.alias("anchor"))
    return b.groupBy("gram", "len", "anchor").agg(F.collect_set("item").alias("items"))


def _bits(hashes: list[int]) -> tuple[Column, int]:
    """A bit filter with two bits for each hash, as a literal array of 64-bit words."""
    size = 1 << max(10, math.ceil(math.log2(max(1, len(hashes)) * 32)))
    bits = np.zeros(size // 64, dtype=np.uint64)
    h = np.array(hashes, dtype=np.int64).astype(np.uint64)
    for part in (h, h >> np.uint64(32)):
        at = part & np.uint64(size - 1)
        np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return F.split(F.lit(",".join(map(str, bits.astype(np.int64).tolist()))), ",").cast("array<bigint>"), size


def _passes(z: Column, bits: Column, size: int) -> Column:
    def bit(part: Column) -> Column:
        at = part.bitwiseAND(F.lit(size - 1))
        word = F.get(bits, F.shiftrightunsigned(at, 6).cast("int"))
        # a shift by a column has no Python function; x >> (at & 63)
        return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return bit(z) & bit(F.shiftrightunsigned(z, 32))


def _positions(flags: Column) -> Column:
    """The indices of an array of nullable integers that are not null."""
    return F.filter(flags, lambda x: x.isNotNull())


def _hashed(gram: Column) -> Column:
    """A window as 16 bytes."""
    return F.struct(F.xxhash64(gram).alias("x"), F.xxhash64(F.lit(SECOND_SEED), gram).alias("y"))


def _candidates(ws: Column, window: int, full: list[int] | None, short: list[int], lens: list[int]) -> Column:
    """array<struct<pos, len, gram>> of the window positions that may hit; full None: every position, hashed."""
    text = lambda i, n: F.array_join(F.slice(ws, i + 1, n), " ")
    gram = lambda i, n: F.struct(i.alias("pos"), n.alias("len"), (_hashed(text(i, n)) if full is None else text(i, n)).alias("gram"))

    def from_hashes(h: Column) -> Column:
        n = F.size(h)
        if full is None:
            at = _positions(F.transform(h, lambda x, i: F.when(i + window <= n, i)))
        elif full:
            bits, size = _bits(full)
            zs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + window // 2), F.get(h, i + window - 1)))
            at = let(bits, lambda b: _positions(F.transform(zs, lambda z, i: F.when((i + window <= n) & _passes(z, b, size), i))))
        else:
            at = F.array().cast("array<int>")
        out = F.transform(at, lambda i: gram(i, F.lit(window)))
        if lens:
            if full is None:
                first = F.transform(h, lambda x, i: i)
            else:
                sbits, ssize = _bits(short)
                first = let(sbits, lambda b: _positions(F.transform(h, lambda x, i: F.when(_passes(x, b, ssize), i))))
            fits = lambda i: F.filter(F.array(*map(F.lit, lens)), lambda k: i + k <= n)
            out = F.concat(out, F.flatten(F.transform(first, lambda i: F.transform(fits(i), lambda k: gram(i, k)))))
        return out

    return let(F.transform(ws, lambda w: F.xxhash64(w)), from_hashes)


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, ratio: int = RATIO, max_broadcast_windows: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per row of docs: id, row_key, n_words, n_hit, n_items, items, spans, contaminated.

    spans: the hit intervals of words, array<struct<start, end>>, end exclusive.
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, window)
    seen = windows.select("len", "anchor").distinct().limit(max_broadcast_windows + 1).collect()
    small = len(seen) <= max_broadcast_windows
    if small:  # the relation holds the windows and, for each, the ids of its items
        n = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("ids")).first()
        small = n.n <= max_broadcast_windows and n.ids <= 10 * max_broadcast_windows
    if small:
        full = [r.anchor for r in seen if r.len == window]
        short, lens = [r.anchor for r in seen if r.len < window], sorted({r.len for r in seen if r.len < window})
    else:
        full, short = None, []
        lens = sorted(r.len for r in windows.filter(F.col("len") < window).select("len").distinct().collect())
    d = docs.select(F.col(id_col).alias("id"), row_key(F.col(text_col)).alias("row_key"), words_of(F.col(text_col)).alias("ws"))
    d = d.withColumn("rid", F.monotonically_increasing_id())
    d = d.select("rid", "id", "row_key", F.size("ws").cast("long").alias("n_words"), _candidates(F.col("ws"), window, full, short, lens).alias("cands"))
    d = d.select("rid", "id", "row_key", "n_words", F.explode_outer("cands").alias("c")).select("rid", "id", "row_key", "n_words", "c.*")
    if small:
        w = F.broadcast(windows.select(F.col("gram").alias("w_gram"), F.col("len").alias("w_len"), "items"))
    else:
        w = materialize(windows.select(_hashed(F.col("gram")).alias("w_gram"), F.col("len").alias("w_len"), "items"), "windows")
    d = d.join(w, (d["gram"] == w["w_gram"]) & (d["len"] == w["w_len"]), "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("pos", (F.col("pos") + F.col("len")).alias("end")))
    d = d.groupBy("rid", "id", "row_key", "n_words").agg(F.array_sort(F.collect_set(hit)).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    merged = F.aggregate(
        "hits",
        F.lit(None).cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(acc.isNull(), F.array(F.struct(x["pos"].alias("start"), x["end"].alias("end")))).when(
            x["pos"] <= F.element_at(acc, -1)["end"],
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["pos"].alias("start"), x["end"].alias("end"))))),
    )
    covered = F.aggregate("hits", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["pos"], acc["to"]))).alias("n"), F.greatest(acc["to"], x["end"]).alias("to")))["n"].cast("long")
    d = d.select("id", "row_key", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", F.coalesce(merged, F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))
    return d.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(ratio) * F.col("n_hit") >= F.col("n_words")))


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the contaminated rows, all columns kept."""
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **how).filter("contaminated").select(F.col("id").alias("_bad_id"), F.col("row_key").alias("_bad_key")).distinct()
    bad = materialize(bad, "contaminated")
    if bad.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        bad = F.broadcast(bad)
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]) & (row_key(docs[text_col]) == bad["_bad_key"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs whose hit words, and what stands between them, are cut out of the text; all columns kept.

    The text is taken apart into words and the gaps around them, so everything outside a hit stays as it was.
    """
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **how).filter("n_hit > 0").select(F.col("id").alias("_bad_id"), F.col("row_key").alias("_bad_key"), F.col("spans").alias("_bad_spans")).dropDuplicates(["_bad_id", "_bad_key"])
    d = docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]) & (row_key(docs[text_col]) == bad["_bad_key"]), "left")
    text = F.col(text_col)
    piece = r"(?:(?![A-Za-z0-9])[\x00-\x7F])+|[A-Za-z0-9\x{80}-\x{10FFFF}]+"
    word = r"^[A-Za-z0-9\x{80}-\x{10FFFF}]"
    pieces = F.regexp_extract_all(text, F.lit(piece), F.lit(0))

    def cut(p: Column) -> Column:
        # k: the words up to and with this piece; a gap inside a hit goes with it
        lead = F.when(F.get(p, F.lit(0)).rlike(word), F.lit(0)).otherwise(F.lit(1))
        k = lambda i: F.floor((i - lead) / 2).cast("int")
        is_word = lambda i: F.pmod(i - lead, F.lit(2)) == 0
        inside = lambda i: F.exists("_bad_spans", lambda s: (k(i) >= s["start"]) & (F.when(is_word(i), k(i)).otherwise(k(i) + 1) < s["end"]))
        return F.array_join(F.filter(p, lambda x, i: ~((i >= lead) & inside(i))), "")

    return d.withColumn(text_col, F.when(F.col("_bad_spans").isNotNull(), let(pieces, cut)).otherwise(text)).select(*[d[c] if c != text_col else F.col(text_col) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT item, least(13, len(ws)) AS n, list_slice(ws, beg, beg + least(13, len(ws)) - 1) AS g
  FROM (SELECT item, ws, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS beg FROM b WHERE len(ws) > 0)),
w AS (SELECT n, list_aggregate(g, 'string_agg', ' ') AS gram, list(DISTINCT item) AS items FROM bw GROUP BY ALL),
lens AS (SELECT DISTINCT n FROM w),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
p AS (SELECT rid, n, ws, unnest(generate_series(1, len(ws) - n + 1)) AS beg FROM d, lens WHERE len(ws) >= n),
h AS (SELECT rid, beg, p.n, items FROM (SELECT rid, beg, n, list_aggregate(list_slice(ws, beg, beg + n - 1), 'string_agg', ' ') AS gram FROM p) p JOIN w ON p.gram = w.gram AND p.n = w.n),
c AS (SELECT rid, count(DISTINCT beg + k) AS n_hit FROM (SELECT rid, beg, unnest(generate_series(0, n - 1)) AS k FROM h) GROUP BY rid),
i AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM (SELECT rid, unnest(items) AS item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN i USING (rid)
"""
