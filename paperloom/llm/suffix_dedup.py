"""Repeated passages by sparse suffix arrays.

A document is its sequence of words (ASCII white space apart, A-Z lower-cased). The suffixes kept
are those at minimiser positions: of every window of ``MIN_WORDS`` words, the suffix with the least
hash of its first ``PREFIX`` words, the leftmost among equals. Content alone selects them, so two
copies of a passage keep the same suffixes, about one word in twenty.

A prefix that only one document has is done with. The kept suffixes of the others travel with the words
that their windows cover, packed, as arrays by (batch, prefix range), and a task makes the sparse suffix
array of one range: it sorts the suffixes by prefix and by what follows, word by word. Matches are extended
to the left one word at a time and, of the suffixes that still agree, neighbours are compared to the right as
far as a window reaches, on the words (64-bit hashes). Suffixes of one cover (all these words alike, as in
copies) travel once a batch and are sorted once, with the least and greatest document that has them. Windows of ``MIN_WORDS`` words that agree and touch
merge into passages of any length. As each window belongs to exactly one kept suffix, in every copy to the
same one, and all suffixes that agree on a window are neighbours, no repeat of ``MIN_WORDS`` words is missed.

Prefixes are grouped by pre-aggregated least and greatest document, never by lists. Windows of prefixes with
over ``HOT_ROWS`` rows (a passage that a third of all documents share) are not sorted in one task: they go as
rows of (window hash, document), pre-aggregated as well and split where they are joined again.

Result: one row for each document with a passage that another document has, with all such passages
(spans of words, end exclusive) and those of them to drop: all but the occurrence in the document
with the least id. Documents without one have no row.

Defined cases: null or short text has no passage; rows with a null id are left out; repeated rows of
one id are one document (a passage must repeat across ids); repeats inside one document alone do
not count; of documents that share a passage the least id keeps it; very long texts are read whole; an empty
table gives no rows; of the columns of docs only id and text are read, so that none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import materialize
from .common import LOWER_BYTES, small_batches, table, tidied
from .jaccard_join import U, mix

MIN_WORDS = 50
PREFIX = 8
BASE = 0x9E3779B97F4A7C15 | 1
#: A prefix of more rows is compared by pre-aggregated rows, any other within one range of prefixes, whose windows fit a task.
HOT_ROWS = 100_000
#: Windows that one task sorts at once.
TASK_WINDOWS = 500_000


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().translate(LOWER_BYTES).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words))


def span_hashes(w: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Hashes of the words from each start on: differences of one prefix sum modulo 2^64, brought to a common power."""
    inverse = pow(BASE, -1, 1 << 64)
    ups, downs = np.full(len(w), U(BASE)), np.full(len(w), U(inverse))
    ups[:1] = downs[:1] = 1
    ups, downs = np.multiply.accumulate(ups), np.multiply.accumulate(downs)
    sums = np.concatenate([np.zeros(1, dtype=U), np.add.accumulate(mix(w) * ups)])
    return mix((sums[starts + sizes] - sums[starts]) * downs[starts])


def window_hashes(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words."""
    return span_hashes(w, np.arange(len(w) - n + 1), n) if len(w) >= n else np.zeros(0, dtype=U)


def minimisers(prefixes: np.ndarray, min_words: int, prefix: int) -> np.ndarray:
    """For every window of min_words words, the place of its kept suffix."""
    span = min_words - prefix + 1
    if len(prefixes) < span:
        return np.zeros(0, dtype=np.int64)
    out = np.empty(len(prefixes) - span + 1, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(prefixes, span)
    for lo in range(0, len(out), 1 << 16):
        out[lo : lo + (1 << 16)] = views[lo : lo + (1 << 16)].argmin(axis=1)
    return out + np.arange(len(out))


def _rows(cols: list[list[np.ndarray]], kinds: list[pa.DataType], at: list[int], ids: pa.Array, names: list[str]) -> pa.RecordBatch:
    owner = np.repeat(np.arange(len(at)), at)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), *[pa.array(np.concatenate(c) if c else np.zeros(0, dtype=np.int64), k) for c, k in zip(cols, kinds, strict=True)]], names=names)


def kept_suffixes(docs: DataFrame, min_words: int, prefix: int) -> DataFrame:
    """(doc, key, pos): the sparse suffix array, unsorted. docs: (doc, text)."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, pos, at = [], [], []
            for t in b.column(1).to_pylist():
                p = window_hashes(word_hashes(t), prefix)
                found = np.unique(minimisers(p, min_words, prefix))
                keys.append(p[found].view(np.int64))
                pos.append(found.astype(np.int32))
                at.append(len(found))
            yield _rows([keys, pos], [pa.int64(), pa.int32()], at, b.column(0), ["doc", "key", "pos"])

    return small_batches(docs).mapInArrow(run, f"doc {dict(docs.dtypes)['doc']}, key long, pos int")


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """rows whose key occurs in more than one document, with the least such document and the number of rows (n_rows)."""
    shared = rows.groupBy(key).agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.count("*").alias("n_rows")).filter("first_doc < last_doc").select(F.col(key).alias("_key"), "first_doc", "n_rows")
    shared = materialize(shared, "shared")
    return rows.join(shared, rows[key] == shared["_key"]).drop("_key")


def _kept(text: str | None, own: list[int], min_words: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes, and of each kept suffix at own its place, the first of the windows that it stands for and how many
    they are; these begin one after another, none behind the suffix."""
    w = word_hashes(text)
    at = minimisers(window_hashes(w, prefix), min_words, prefix)
    found = np.flatnonzero(np.isin(at, np.array(own, dtype=np.int64)))
    cut = np.flatnonzero(np.concatenate([[True], at[found][1:] != at[found][:-1]])) if len(found) else found
    return w, at[found[cut]], found[cut], np.diff(np.append(cut, len(found)))


def _spread(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... counts[0] times, then from first[1], and so on."""
    ends = np.cumsum(counts, dtype=np.int64)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first.astype(np.int64) - ends + counts, counts)


def _compare(key: np.ndarray, left: np.ndarray, counts: np.ndarray, words: np.ndarray, lowest: np.ndarray, highest: np.ndarray, min_words: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of kept suffixes that another document has: the suffix, how many words before it the window begins, the least
    document with it.

    Of each suffix: its prefix, how many words its first window begins before it, the number of its windows, the words (hashes)
    that they cover, one after another, and the least and greatest of the documents that have it with all these words. Suffixes are
    sorted by prefix and then by what follows, word by word. Matches are extended to the left one word at a time: of the suffixes
    that agree on the words so far, neighbours in the sorted order are compared to the right, on the words themselves, as far as a
    window reaches.
    """
    reach = min_words - prefix  # words of a window left of its suffix at most
    w = np.zeros((len(key), reach + min_words), dtype=U)
    sizes = counts + min_words - 1
    row = np.repeat(np.arange(len(key)), sizes)
    w[row, _spread(reach - left, sizes)] = words
    # the sparse suffix array: prefix by prefix, in the order of the words behind
    order = np.lexsort([w[:, c] for c in range(reach + min_words - 1, reach + prefix - 1, -1)] + [key]) if len(key) else np.zeros(0, dtype=np.int64)
    group = key.copy()
    found = []
    alive = order
    for l in range(reach + 1):
        # those that reach so far to the left, and agree on it with another document
        alive = alive[left[alive] >= l]
        if l:
            group[alive] = mix(group[alive] * U(BASE) + w[alive, reach - l])
        alive = alive[np.argsort(group[alive], kind="stable")]
        if not len(alive):
            break
        g = group[alive]
        edge = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        many = np.minimum.reduceat(lowest[alive], edge) != np.maximum.reduceat(highest[alive], edge)
        alive = alive[np.repeat(many, np.diff(np.append(edge, len(alive))))]
        here = alive[left[alive] - counts[alive] < l]  # those that stand for the window that begins l words before them
        if not len(here):
            continue
        same = np.zeros(len(here), dtype=bool)
        for lo in range(1, len(here), 1 << 14):
            x, y = here[lo - 1 : lo - 1 + (1 << 14)], here[lo : lo + (1 << 14)]
            x = x[: len(y)]
            same[lo : lo + len(y)] = (w[x, reach - l : reach - l + min_words] == w[y, reach - l : reach - l + min_words]).all(axis=1)
        edge = np.flatnonzero(~same)
        least, most = np.minimum.reduceat(lowest[here], edge), np.maximum.reduceat(highest[here], edge)
        size = np.diff(np.append(edge, len(here)))
        least, keep = np.repeat(least, size), np.repeat(least != most, size)
        found.append((here[keep], np.full(int(keep.sum()), l), least[keep]))
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([x[i] for x in found]) if found else empty for i in range(3))


def _runs(names: np.ndarray, kind: pa.DataType, doc: np.ndarray, starts: np.ndarray, least: np.ndarray, sizes: np.ndarray) -> pa.Table:
    """One row a document: the runs of its repeated windows, whether another document comes first, and the least such one."""
    keep = np.lexsort((starts, doc))
    doc, starts, least = doc[keep], starts[keep], least[keep]
    later = least < doc
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (starts[1:] != starts[:-1] + 1) | (later[1:] != later[:-1])]) if len(doc) else np.zeros(0, dtype=bool)
    run = np.flatnonzero(new)
    cut = np.flatnonzero(np.concatenate([[True], doc[run][1:] != doc[run][:-1]])) if len(run) else run
    edges = pa.array(np.append(cut, len(run)).astype(np.int32))
    taken = doc[run][cut]
    lists = lambda x, t: pa.ListArray.from_arrays(edges, pa.array(x, t))
    by = lambda x: pa.array(names[x].tolist(), kind)
    ends = starts[np.append(run[1:], len(doc)) - 1] if len(run) else starts
    return pa.table([by(taken), pa.array(sizes[taken]), lists(starts[run], pa.int32()), lists(ends, pa.int32()), lists(later[run], pa.bool_()), by(np.minimum.reduceat(least, run[cut]) if len(cut) else least)], names=["doc", "n_words", "starts", "ends", "later", "first_doc"])


def passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, prefix: int = PREFIX) -> DataFrame:
    """(id, n_words, n_repeated, spans, n_drop, drop_spans, first_doc)."""
    kind = dict(docs.dtypes)[id_col]
    d = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter(F.col("doc").isNotNull() & F.col("text").isNotNull())
    suffixes = materialize(kept_suffixes(d, min_words, prefix), "suffixes")
    hot = F.col("n_rows") > HOT_ROWS
    places = repeated(suffixes, "key").groupBy("doc").agg(F.collect_set(F.when(~hot, F.col("pos"))).alias("places"), F.collect_set(F.when(hot, F.col("pos"))).alias("hot_places"))
    places = materialize(places, "places")
    size = places.agg(F.sum(F.size("places")).alias("cold"), F.sum(F.size("hot_places")).alias("hot")).first()
    # the places grow with the corpus, so the texts are dealt out by document whatever the size
    marked = d.join(places.hint("merge"), "doc").select("doc", "text", "places", "hot_places")
    spark = docs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size.cold or 0) * (min_words - prefix + 2) // 2 // TASK_WINDOWS))

    @tidied
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_kept(t, own, min_words, prefix) for t, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            if not found:
                continue
            place, first, counts = (np.concatenate([x[i] for x in found]) for i in (1, 2, 3))
            owner, sizes = np.repeat(np.arange(len(found)), [len(x[1]) for x in found]), np.array([len(x[0]) for x in found], dtype=np.int32)
            offset = np.cumsum(sizes, dtype=np.int64) - sizes
            w = np.concatenate([x[0] for x in found])
            prefixes = np.concatenate([window_hashes(x[0], prefix)[x[1]] for x in found])
            # suffixes of one cover (all words of their windows, and the place among them) travel once a batch
            covers = np.concatenate([span_hashes(x[0], x[2], x[3] + min_words - 1) for x in found])
            covers = mix(covers ^ mix((place - first).astype(U) * U(BASE) + counts.astype(U)))
            part = (((prefixes >> U(32)) * U(ranges)) >> U(32)).astype(np.int32)
            order = np.lexsort((covers, part))
            place, first, counts, owner, part, prefixes, covers = (x[order] for x in (place, first, counts, owner, part, prefixes, covers))
            new = np.concatenate([[True], (covers[1:] != covers[:-1]) | (part[1:] != part[:-1])]) if len(part) else np.zeros(0, dtype=bool)
            one, which = np.flatnonzero(new), np.cumsum(new) - 1
            spans = counts[one] + min_words - 1
            w = w[_spread(first[one] + offset[owner[one]], spans)]
            at = np.concatenate([[0], np.cumsum(spans, dtype=np.int64)])
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
            rows = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                own, k, m = owner[lo:hi], which[lo], which[hi - 1] + 1
                mine = one[k:m]
                rows.append((int(part[lo]), own, sizes[own].tobytes(), place[lo:hi].astype(np.int32).tobytes(), (which[lo:hi] - k).astype(np.int32).tobytes(), covers[mine].tobytes(), prefixes[mine].tobytes(), (place - first)[mine].astype(np.int32).tobytes(), counts[mine].astype(np.int32).tobytes(), w[at[k] : at[m]].tobytes()))
            if rows:
                offsets = pa.array(np.cumsum([0] + [len(r[1]) for r in rows]).astype(np.int32))
                ids = pa.ListArray.from_arrays(offsets, b.column(0).take(pa.array(np.concatenate([r[1] for r in rows]))))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), ids, *[pa.array([r[i] for r in rows], pa.binary()) for i in range(2, 10)]], names=["p", "docs", "sizes", "places", "which", "covers", "prefixes", "lefts", "counts", "words"])

    @tidied
    def compare(t):
        column = lambda name, kind: np.frombuffer(b"".join(t.column(name).to_pylist()), kind)
        lengths = lambda name, size: np.array([len(x) // size for x in t.column(name).to_pylist()], dtype=np.int64)
        docs = t.column("docs").combine_chunks().flatten()
        names, code = np.unique(docs.to_numpy(zero_copy_only=False), return_inverse=True)
        sizes = np.zeros(len(names), dtype=np.int64)
        sizes[code] = column("sizes", np.int32)
        place, covers = column("places", np.int32).astype(np.int64), column("covers", U)
        per = lengths("covers", 8)
        which = column("which", np.int32) + np.repeat(np.cumsum(per) - per, lengths("which", 4))
        # one of each cover, with the least and greatest document that has it
        _, one, same = np.unique(covers, return_index=True, return_inverse=True)
        which = same[which]
        lowest, highest = np.full(len(one), len(names)), np.full(len(one), -1)
        np.minimum.at(lowest, which, code)
        np.maximum.at(highest, which, code)
        counts = column("counts", np.int32).astype(np.int64)
        spans = counts + min_words - 1
        words = column("words", U)[_spread((np.cumsum(spans) - spans)[one], spans[one])]
        at, back, least = _compare(column("prefixes", U)[one], column("lefts", np.int32).astype(np.int64)[one], counts[one], words, lowest, highest, min_words, prefix)
        # and for every document that has the cover
        order = np.argsort(at, kind="stable")
        at, back, least = at[order], back[order], least[order]
        begin, end = np.searchsorted(at, which), np.searchsorted(at, which, side="right")
        pick = _spread(begin, end - begin)
        entry = np.repeat(np.arange(len(which)), end - begin)
        return _runs(names, docs.type, code[entry], place[entry] - back[pick], least[pick], sizes)

    packed = small_batches(marked.filter(F.size("places") > 0).select("doc", "text", "places")).mapInArrow(deal, f"p int, docs array<{kind}>, sizes binary, places binary, which binary, covers binary, prefixes binary, lefts binary, counts binary, words binary")
    found = packed.groupBy("p").applyInArrow(compare, f"doc {kind}, n_words long, starts array<int>, ends array<int>, later array<boolean>, first_doc {kind}")
    if size.hot:
        # prefixes that very many documents have: rows, pre-aggregated by window, so that no task holds all of one

        @tidied
        def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                every = [_kept(t, own, min_words, prefix) for t, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                starts = [_spread(first, counts) for _, _, first, counts in every]
                hashes = [window_hashes(x[0], min_words)[s].view(np.int64) for x, s in zip(every, starts, strict=True)]
                yield _rows([hashes, [s.astype(np.int32) for s in starts], [np.full(len(s), len(x[0]), dtype=np.int32) for x, s in zip(every, starts, strict=True)]], [pa.int64(), pa.int32(), pa.int32()], [len(s) for s in starts], b.column(0), ["doc", "hash", "start", "n_words"])

        windows = small_batches(marked.filter(F.size("hot_places") > 0).select("doc", "text", "hot_places")).mapInArrow(extend, f"doc {kind}, hash long, start int, n_words int")
        more = repeated(materialize(windows, "windows"), "hash").groupBy("doc").agg(F.max("n_words").cast("long").alias("n_words"), F.collect_list("start").alias("starts"), F.collect_list("start").alias("ends"), F.collect_list(F.col("first_doc") < F.col("doc")).alias("later"), F.min("first_doc").alias("first_doc"))
        found = found.unionByName(more)
    found = found.groupBy("doc").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"), F.flatten(F.collect_list("later")).alias("later"), F.min("first_doc").alias("first_doc"))

    @tidied
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
            if not len(starts):
                return []
            order = np.argsort(starts, kind="stable")
            lo, hi = starts[order], np.maximum.accumulate(ends[order] + min_words)
            cut = np.flatnonzero(lo[1:] > hi[:-1])
            return list(zip(lo[np.append(0, cut + 1)].tolist(), hi[np.append(cut, len(lo) - 1)].tolist(), strict=True))

        for b in batches:
            cols = [b.column(0), b.column(1)]
            runs = list(zip(*([np.array(x) for x in b.column(i).to_pylist()] for i in (2, 3, 4)), strict=True))
            for chosen in ([(s, e) for s, e, _ in runs], [(s[f], e[f]) for s, e, f in runs]):
                every = [spans(s, e) for s, e in chosen]
                cols += [pa.array([sum(e - s for s, e in x) for x in every], pa.int64()), pa.array([",".join(f"{s}:{e}" for s, e in x) for x in every], pa.string())]
            yield pa.RecordBatch.from_arrays([*cols, b.column(5)], names=["doc", "n_words", "n_repeated", "spans", "n_drop", "drop_spans", "first_doc"])

    out = small_batches(found).mapInArrow(merge, f"doc {kind}, n_words long, n_repeated long, spans string, n_drop long, drop_spans string, first_doc {kind}")
    return out.withColumnRenamed("doc", id_col)


def drop_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the words of later occurrences (and the white space after each); all columns kept."""
    import re

    found = passages(docs, id_col=id_col, text_col=text_col, **how).filter("n_drop > 0").select(F.col(id_col).alias("_doc"), F.col("drop_spans").alias("_spans"))
    d = docs.join(found, docs[id_col] == found["_doc"], "left").drop("_doc")
    at, names = docs.columns.index(text_col), docs.columns

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
        for b in batches:
            cols = list(b.columns[: len(names)])
            out = []
            for t, s in zip(cols[at].to_pylist(), b.columns[-1].to_pylist(), strict=True):
                if t and s:
                    words = list(word.finditer(t))
                    spans = [tuple(map(int, x.split(":"))) for x in s.split(",")]
                    parts, last = [], 0
                    for lo, hi in spans:
                        parts.append(t[last : words[lo].start()])
                        last = words[hi - 1].end()
                    t = "".join([*parts, t[last:]])
                out.append(t)
            cols[at] = pa.array(out, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return small_batches(d).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    return passages(table(spark, sf_dir, "documents"))


#: The same rows by all windows of 50 words.
SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents WHERE doc_id IS NOT NULL),
w AS (SELECT doc_id, i - 1 AS s, hash(array_to_string(list_slice(ws, i, i + 49), ' ')) AS h FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM d)),
g AS (SELECT h, min(doc_id) AS first_doc FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
m AS (SELECT DISTINCT doc_id, s, first_doc FROM w JOIN g USING (h)),
every AS (SELECT doc_id, s, FALSE AS drop_it FROM m UNION ALL SELECT doc_id, s, TRUE FROM m WHERE first_doc < doc_id),
cuts AS (SELECT *, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id, drop_it ORDER BY s) + 50 THEN 1 ELSE 0 END AS cut FROM every),
isl AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, drop_it ORDER BY s) AS island FROM cuts),
sp AS (SELECT doc_id, drop_it, min(s) AS lo, max(s) + 50 AS hi FROM isl GROUP BY doc_id, drop_it, island),
o AS (SELECT doc_id, CAST(sum(hi - lo) FILTER (NOT drop_it) AS BIGINT) AS n_repeated, string_agg(lo || ':' || hi, ',' ORDER BY lo) FILTER (NOT drop_it) AS spans,
  CAST(coalesce(sum(hi - lo) FILTER (drop_it), 0) AS BIGINT) AS n_drop, coalesce(string_agg(lo || ':' || hi, ',' ORDER BY lo) FILTER (drop_it), '') AS drop_spans FROM sp GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, n_repeated, spans, n_drop, drop_spans, f.first_doc
FROM o JOIN d USING (doc_id) JOIN (SELECT doc_id, min(first_doc) AS first_doc FROM m GROUP BY 1) f USING (doc_id)
"""
