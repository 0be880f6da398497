"""N-gram Jaccard join by a partitioned universe and the pigeonhole principle, verified exactly.

Sets. A document's set holds the 64-bit hashes of its distinct 5-word shingles. Equal sets have one
64-bit id; everything after the first pass is about ids, so exact copies cost one row each and no
pair.

Partition. Sets are banded by size. For a pair whose smaller set lies in band k, at most
H <= (|X|+|Y|)/7 elements differ (Jaccard >= 3/4). The universe of shingles is hashed into
m_k > H_k segments, so a linked pair agrees on at least m_k - H segments. For every segment that
holds any of its elements a set has a key: the order-free hash of that subset. A set has keys in its
own band and in a lower band that may hold its partners. Only the keys of its first H+1 such segments travel, and a few more
that it may pass over (``spare_keys``, as many for all sets of a band): of two linked sets the one whose keys end first
agrees with the other on one of them at least, which the other, whose keys end later, sends too. Keys travel packed, as arrays by
(batch, key range), and a task sorts the keys of one key range. A key that ``THIN`` sets of one batch share is
thinned there: its members go to any task, as known members of a larger group and as a star around one of them,
and this one alone goes on to the key's range, so that no task holds all sets of a hot key. Of a key its range and its lowest
four bytes are kept: a range holds about TASK_KEYS keys at any size of the input, so some 260 pairs of its
different keys fall together, and verification drops what that brings.

Candidates. Sets that share a key: groups of up to SMALL give all pairs, larger groups a star
around their least id in the first round and around others in the next ones. Stars and pairs are thinned by an exact bound (the
Hamming distance of parity bitmaps never exceeds the number of differing elements), verified on the
sets themselves and joined into components; each round looks only at keys whose sets are still in
different components. What the stars leave is matched pair by pair: up to HOT sets a key, all pairs across components. A key of more sets than
that (a passage that many documents share) is passed over by every set that can afford it: m_k has
slack, and the pigeonhole argument needs H+1 segments only (cost-based allocation). Sets that
cannot afford it, and only those, match each other by one-deletion neighbourhoods, each segment of
which stands for two; and the few for which even that is not enough (most of their elements are in
crowded segments) are matched by their rarest elements, of which linked sets share one. A set with no more
segments than elements may differ (its hashes fall together; hardly ever) is held against all sets. So no link
between different texts is lost, though pairs inside one component need not be listed.

Recovery: each round's tables are written to the shared folder. Nothing but scalars reaches the
driver.

Defined cases: null, empty or wordless text has an empty set, component of its own id and no link;
fewer than five words make one shingle; repeated rows share a component; a null doc_id joins groups
but never names one unless alone; a similarity of exactly 0.75 links; very long texts count whole, their
keys are bounded by their length; an empty table gives no rows; of the columns of docs only id and text are
read, so that none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.store import discard, materialize
from .common import LOWER_BYTES, row_key, small_batches, table, tidied

WORDS = 5
#: Jaccard >= 3/4: at most (|X|+|Y|)/7 elements differ, and sizes differ by 4/3 at most.
SLACK = 0.2
#: Sets up to about this size are matched by single elements.
SINGLES = 32
SMALL, HOT = 4, 64
#: Keys that one task sorts at once.
TASK_KEYS = 1_500_000
#: Sets of one batch that share a key from which on only one of them goes on to the key's range; the others are known members.
THIN = 32
#: Bytes of a key that travel; its range stands for the highest bits.
KEY_BYTES = 4
#: Keys that a set sends beyond those it needs, as a share of what the largest set of the band needs.
SPARE = 0.4
#: Below this many, ids of documents to be read again are broadcast (16 MB).
BROADCAST_ROWS = 1_000_000
#: Longs of those that carry lists of keys (32 MB).
BROADCAST_LONGS = 4_000_000
#: Roles of keys in the last round: of segments that stand for two, with one element less, of segments that count, of all segments of a possible partner; elements themselves.
WHOLE, LESS, SAME, ANY_WHOLE, ANY_LESS, ELEMENT = range(6)
#: A set whose probes meet more keys of others than this is matched by its elements.
DEAR = 200
#: Rounds of stars over the larger groups before what is left is matched pair by pair.
STAR_ROUNDS = 1
U = np.uint64
_SHINGLE = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or "").encode().translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, dtype=U)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words))
    n = max(1, len(w) - WORDS + 1)
    out = np.full(n, U(min(len(w), WORDS)), dtype=U)
    for i in range(min(WORDS, len(w))):
        out += mix(w[i : i + n] * _SHINGLE[i])
    return np.unique(mix(out))


def set_id(h: np.ndarray) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], dtype=U).view(np.int64)[0])


def _bands() -> list[int]:
    """The least size of each band; sizes grow by 1.8."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, int(low[-1] * 1.8)))
    return low


BANDS = np.array(_bands(), dtype=np.int64)


def band(n: int) -> int:
    return int(np.searchsorted(BANDS, n, side="right")) - 1


def most_differing(n: int, k: int) -> int:
    """H of a set of n elements in band k: over all partners of pairs whose smaller set lies in that band."""
    top = int(BANDS[k + 1]) - 1
    return (n + (4 * n) // 3) // 7 if band(n) == k else (n + top) // 7


def most_needed(k: int) -> int:
    """H+1 of the largest set of band k."""
    top = int(BANDS[k + 1]) - 1
    return (top + (4 * top) // 3) // 7 + 1


def spare_keys(k: int) -> int:
    """The keys that a set may pass over in band k; as many for all its sets, or two linked ones could pass over all that they share."""
    return 2 + int(SPARE * most_needed(k))


def segments(k: int) -> int:
    """m_k: enough for H+1 non-empty ones with a margin of over five deviations; in the lowest bands every element is a segment of its own."""
    top, need = int(BANDS[k + 1]) - 1, most_needed(k)
    return 1 << 32 if top <= SINGLES else int(np.ceil(need * (1 + SLACK + 3 / np.sqrt(need))))


def bands_of(n: int) -> range:
    """A set's own band and the lower ones that hold possible partners."""
    return range(band(-(-3 * n // 4)), band(n) + 1)


def parts(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment, subset sum and first place of each non-empty segment, and the elements' hashes in segment order."""
    m = segments(k)
    s = ((mix(h ^ U(0xA5A5A5A5 + k)) >> U(32)) * U(m)) >> U(32)
    order = np.argsort(s, kind="stable")
    s, g = s[order], mix(h[order] + U(0x632BE59BD9B4E019))
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.add.reduceat(g, first), first, g


def keyed(segment: np.ndarray, total: np.ndarray, k: int) -> np.ndarray:
    return mix(total ^ mix(segment + U((k + 1) << 40)))


def keys(h: np.ndarray, k: int) -> np.ndarray:
    segment, total, _, _ = parts(h, k)
    return keyed(segment, total, k)


def keys_sent(h: np.ndarray, k: int) -> int:
    """How many of its keys a set sends, the first ones by segment."""
    return most_differing(len(h), k) + 1 + spare_keys(k)


def range_of(k: np.ndarray, ranges: int) -> np.ndarray:
    return (((k >> U(32)) * U(ranges)) >> U(32)).astype(np.int32)


def packed(k: np.ndarray) -> bytes:
    return np.ascontiguousarray(k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def unpacked(data: bytes, part: np.ndarray | int) -> np.ndarray:
    """The keys that packed() shortened, as longs, with their ranges above."""
    out = np.zeros((len(data) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return (out.reshape(-1).view("<u8").astype(U) | np.asarray(part).astype(U) << U(8 * KEY_BYTES)).view(np.int64)


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers, first all their lowest bytes: the others hardly differ, so they are compressed away."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.tobytes()


def shortened(k: np.ndarray, ranges: int) -> np.ndarray:
    """Keys as they are known once they have travelled."""
    return unpacked(packed(k), range_of(k, ranges))


def deletions(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each segment with one element left out, the place of its segment among the non-empty ones, and those segments' sizes.

    A segment of one element gives the key of an empty one, which no set has.
    """
    segment, total, first, g = parts(h, k)
    at = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(g))))
    out = keyed(segment[at], total[at] - g, k)
    return out.view(np.int64), at, np.diff(np.append(first, len(g)))


def bitmap(h: np.ndarray) -> bytes:
    """Parities of the elements by a hash; 8 bits at least, about one bit an element."""
    bits = 8 << max(0, (max(1, len(h)) - 1).bit_length() - 3)
    at = (mix(h + U(0x1234567)) & U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """A lower bound of the number of differing elements; the longer bitmap is folded onto the shorter one's length."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * |intersection| >= 75 * |union| of two sorted arrays without repeats."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return len(x) + len(y) > 0 and 4 * both >= 3 * (len(x) + len(y) - both)


def _batch(cols: dict, schema: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[n], t) for n, t in schema], names=[n for n, _ in schema])


def describe(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """(doc_id, id, n, bitmap) and, if keyed, row_key: the first pass over the texts."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column(1).to_pylist()]
            found = [b.column(0), pa.array([set_id(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64()), pa.array([bitmap(h) for h in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([*found, *b.columns[2:]], names=["doc_id", "id", "n", "bitmap", *["row_key"] * keyed])

    cols = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[row_key(F.col(text_col)).alias("row_key")] * keyed]
    return small_batches(docs.select(*cols)).mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, id long, n long, bitmap binary" + ", row_key long" * keyed)


_PACKED = [("p", pa.int32()), ("ids", pa.binary()), ("bands", pa.binary()), ("spare", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("centres", pa.binary())]


def _hot_entries(every: np.ndarray, owner: np.ndarray, thin: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the keys that `thin` sets of a batch or more share: the places of all their entries, and of each the least owner's."""
    low = (every & U((1 << 20) - 1)).astype(np.int64)
    often = np.flatnonzero((np.bincount(low, minlength=1 << 20) >= thin)[low])  # a bound from above, so that few keys are sorted
    often = often[np.lexsort((owner[often], every[often]))]
    k, o = every[often], owner[often]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(k)))
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]) if len(k) else np.zeros(0, dtype=bool)
    sets = np.add.reduceat(new.astype(np.int64), first) if len(k) else size
    hot = np.repeat(sets >= thin, size)
    return often[hot], np.repeat(often[first], size)[hot]


def signatures(docs: DataFrame, ranges: int, *, text_col: str = "text", thin: int = THIN) -> DataFrame:
    """Packed keys: for each batch and key range the sets that have keys there, their bands, how many, and the keys."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, bands, spare, found, ids = [], [], [], [], []
            for t in b.column(0).to_pylist():
                h = shingles(t)
                if len(h):
                    ids.append(set_id(h))
                    for k in bands_of(len(h)):
                        found.append(keys(h, k)[: keys_sent(h, k)])
                        owner.append(len(ids) - 1)
                        bands.append(k)
                        spare.append(len(found[-1]) - most_differing(len(h), k) - 1)
            if not found:
                continue
            ids, bands, spare, owner = np.array(ids, dtype=np.int64), np.array(bands, dtype=np.uint8), np.array(spare, dtype=np.int32), np.array(owner)
            entry = np.repeat(np.arange(len(found)), [len(x) for x in found])
            every = np.concatenate(found)
            out: dict = {n: [] for n, _ in _PACKED}
            hot, centre = _hot_entries(every, ids[owner[entry]], thin)
            if len(hot):
                # members of hot keys go to any task, each with its key and the key's centre; only the centre goes to the key's range
                e = entry[hot]
                for lo in range(0, len(hot), 10_000):
                    x = slice(lo, lo + 10_000)
                    out["p"].append(int(every[hot[lo]] ^ ids[0].view(U)) % ranges)
                    for name, values in (("ids", ids[owner[e[x]]]), ("bands", bands[e[x]]), ("keys", shortened(every[hot[x]], ranges)), ("centres", ids[owner[entry[centre[x]]]])):
                        out[name].append(values.tobytes())
                    out["spare"].append(planes(spare[e[x]]))
                    out["counts"].append(b"")
                stays = np.ones(len(every), dtype=bool)
                stays[hot] = False
                stays[centre] = True
                every, entry = every[stays], entry[stays]
            part = range_of(every, ranges)
            order = np.argsort(part, kind="stable")
            part, entry, every = part[order], entry[order], every[order]
            edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                e = entry[lo:hi]
                starts = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
                own = e[starts]
                out["p"].append(int(part[lo]))
                out["ids"].append(ids[owner[own]].tobytes())
                out["bands"].append(bands[own].tobytes())
                out["spare"].append(planes(spare[own]))
                out["counts"].append(planes(np.diff(np.append(starts, hi - lo))))
                out["keys"].append(packed(every[lo:hi]))
                out["centres"].append(None)
            yield _batch(out, _PACKED)

    return small_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "p int, ids binary, bands binary, spare binary, counts binary, keys binary, centres binary")


@tidied
def _group(t):
    """The pairs of one key range (key null), the members of its larger groups (b null) and of hot keys, and the sets with fewer
    segments than may differ (key and b null): no key of theirs is sure to be shared."""
    is_hot = pc.is_valid(t.column("centres"))
    hot, t = t.filter(is_hot), t.filter(pc.invert(is_hot))
    column = lambda name, kind: np.frombuffer(b"".join(t.column(name).to_pylist()), kind)
    ids, bands, spare, counts = column("ids", np.int64), column("bands", np.uint8), column("spare", np.int32), column("counts", np.uint32)
    k = unpacked(b"".join(t.column("keys").to_pylist()), t.column("p")[0].as_py() if len(t) else 0)
    entry = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
    # only keys that occur again matter
    order = np.argsort(k, kind="stable")
    s = k[order]
    same = s[1:] == s[:-1]
    order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(s) else order
    order = order[np.lexsort((ids[entry[order]], k[order]))]
    k, entry = k[order], entry[order]
    i = ids[entry]
    keep = np.concatenate([[True], (k[1:] != k[:-1]) | (i[1:] != i[:-1])]) if len(k) else np.zeros(0, dtype=bool)
    k, i, entry = k[keep], i[keep], entry[keep]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(k)))
    run = np.repeat(np.arange(len(first)), size)
    pairs = []
    for gap in range(1, SMALL):  # neighbours at each distance, in small groups
        x = np.flatnonzero((run[gap:] == run[:-gap]) & (size[run[gap:]] <= SMALL)) if len(run) > gap else np.zeros(0, dtype=np.int64)
        pairs.append(np.stack([i[x], i[x + gap]], axis=1))
    large = np.flatnonzero(size[run] > SMALL) if len(run) else np.zeros(0, dtype=np.int64)
    spoke = large[large != first[run[large]]]
    pairs.append(np.stack([i[first[run[spoke]]], i[spoke]], axis=1))
    pairs = np.unique(np.concatenate(pairs), axis=0) if len(k) else np.zeros((0, 2), dtype=np.int64)
    column = lambda name, kind: np.frombuffer(b"".join(hot.column(name).to_pylist()), kind)
    hot_ids, centres = column("ids", np.int64), column("centres", np.int64)
    spokes = np.unique(np.stack([centres, hot_ids], axis=1)[centres != hot_ids], axis=0)
    pairs = np.concatenate([pairs, spokes])
    lean = np.unique(np.concatenate([ids[spare < 0], hot_ids[column("spare", np.int32) < 0]]))
    n, m = len(pairs), len(large) + len(hot_ids)
    parts_of = lambda first, second, kind: np.concatenate([np.zeros(n, dtype=kind), first[large].astype(kind), second.astype(kind), np.zeros(len(lean), dtype=kind)])
    at = np.arange(n + m + len(lean))
    is_pair, is_member = at < n, (at >= n) & (at < n + m)
    a = np.concatenate([pairs[:, 0], i[large], hot_ids, lean])
    b = pa.array(np.concatenate([pairs[:, 1], np.zeros(m + len(lean), dtype=np.int64)]), mask=~is_pair)
    key, bands, spare = (pa.array(x, mask=~is_member) for x in (parts_of(k, column("keys", np.int64), np.int64), parts_of(bands[entry], column("bands", np.uint8), np.int32), np.maximum(parts_of(spare[entry], column("spare", np.int32), np.int32), 0)))
    return pa.table([pa.array(a), b, key, bands, spare], names=["a", "b", "key", "band", "spare"])


def _group_sent(t):
    """_group of rows as they travel."""
    for name in ("spare", "counts"):
        t = t.set_column(t.schema.get_field_index(name), name, pa.array([from_planes(x) for x in t.column(name).to_pylist()], pa.binary()))
    return _group(t)


def _read_again(docs: DataFrame, wanted: DataFrame, extra: list[str], *, id_col: str, text_col: str, longs: Column | None = None) -> DataFrame:
    """(text, id, *extra) of one document for each row (id, label, *extra) of wanted."""
    w = wanted.select(F.col("label").alias("_label"), F.col("id").alias("_id"), *extra)
    small = w.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if small and longs is not None:
        small = (w.agg(F.sum(longs)).first()[0] or 0) <= BROADCAST_LONGS
    if small:
        w = F.broadcast(w)
    d = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    return d.join(w, F.col("_doc").eqNullSafe(F.col("_label"))).select("_text", "_id", *extra)


def verify(docs: DataFrame, sets: DataFrame, pairs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The linked pairs (a, b) of ids, written. sets: (id, label, n, bitmap), one row an id."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("bitmap").alias(f"bits{x}"))

    @tidied
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in b.schema.names}
            keep = [3 * max(x, y) <= 4 * min(x, y) and apart(p, q) <= (x + y) // 7 for x, y, p, q in zip(c["na"], c["nb"], c["bitsa"], c["bitsb"], strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "close")
    if close.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # then the sets, with their bitmaps, are dealt out once instead of twice
        close = F.broadcast(close)
    near = small_batches(close.join(side("b"), "b").join(side("a"), "a").filter((3 * F.greatest("na", "nb") <= 4 * F.least("na", "nb")))).mapInArrow(bounded, "a long, b long")
    near = materialize(near, "near")
    wanted = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct()
    wanted = sets.join(wanted, "id", "left_semi").select("id", "label")

    @tidied
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(want, h.tobytes()) for t, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if set_id(h := shingles(t)) == want]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.binary())], names=["id", "h"])

    bodies = small_batches(_read_again(docs, wanted, [], id_col=id_col, text_col=text_col)).mapInArrow(again, "id long, h binary")
    bodies = materialize(bodies, "sets")
    # only rows of one document id and one text bring a set twice; sets are dealt out for that only where it is so
    if bodies.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        every, bodies = bodies, materialize(bodies.dropDuplicates(["id"]), "sets")
        discard(every)
    # a star's centre may have very many pairs: they are dealt over several tasks, its set goes to each
    salts = near.groupBy("a").agg(F.ceil(F.count("*") / 500).cast("int").alias("salts"))
    dealt = near.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    if near.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # then only sets beside their pairs are dealt out
        salts, dealt = F.broadcast(salts), F.broadcast(dealt)
    centres = bodies.join(salts, bodies["id"] == salts["a"]).select("a", F.col("h").alias("ha"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    both = dealt.join(bodies.select(F.col("id").alias("b"), F.col("h").alias("hb")), "b").join(centres, ["a", "salt"]).select("a", "b", "ha", "hb")

    @tidied
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [linked(np.frombuffer(x, U), np.frombuffer(y, U)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    out = materialize(small_batches(both).mapInArrow(exact, "a long, b long"), "links")
    discard(near)
    discard(bodies)
    return out


def _open(members: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, key, band, root, n, used): the members of large groups whose sets are in different components yet, written.

    Each set passes over its most crowded open keys, as many as it can spare (used false). Crowding orders all
    keys alike, so the least crowded key that two linked sets share is used by both.
    """
    m = members.select(F.col("a").alias("id"), "key", "band", "spare").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    # written first: then two plain scans meet, and a key that a third of all sets have is split at run time
    open_keys = materialize(m.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).filter("lo < hi").select("key", "size"), "open-keys")
    m = m.join(open_keys, "key").withColumn("at", F.row_number().over(Window.partitionBy("id", "band").orderBy(F.desc("size"), F.desc("key"))))
    return materialize(m.join(sets.select("id", "n"), "id").select("id", "key", "band", "root", "n", (F.col("at") > F.col("spare")).alias("used")), "open")


def _stars(m: DataFrame, seed: int) -> DataFrame:
    """Pairs (a, b): the members of each open key with one of them, another for each key and seed; across components only."""
    centre = m.groupBy("key").agg(F.min_by(F.struct("id", "root", "n"), F.xxhash64("id", "key", F.lit(seed))).alias("c")).select("key", F.col("c.id").alias("b"), F.col("c.root").alias("rb"), F.col("c.n").alias("nb"))
    centre = materialize(centre, "centres")
    return m.join(centre, "key").filter((F.col("root") != F.col("rb")) & (3 * F.greatest("n", "nb") <= 4 * F.least("n", "nb"))).select(F.col("id").alias("a"), "b").distinct()


def _all_left(docs: DataFrame, sets: DataFrame, m: DataFrame, ranges: int, *, id_col: str, text_col: str) -> DataFrame:
    """Pairs (a, b) of ids from different components that may be linked and that no earlier pair covers. m: the open members of large groups."""

    def across(rows: DataFrame) -> DataFrame:
        x, y = rows.select("key", F.col("id").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na")), rows.select("key", F.col("id").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"))
        return x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & (3 * F.greatest("na", "nb") <= 4 * F.least("na", "nb"))).select("a", "b")

    used = m.filter("used")
    crowded = used.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > HOT).select("key")
    crowded = materialize(crowded, "crowded")
    pairs = across(used.join(crowded, "key", "left_anti"))
    if not crowded.limit(1).count():
        return pairs
    # the sets that still use a crowded key, and the keys they cannot count on
    idle = m.join(crowded.withColumn("hot", F.lit(True)), "key", "left").filter(~F.col("used") | F.col("hot"))
    over = idle.groupBy("id", "band").agg(F.collect_set("key").alias("hot_keys"), F.first("root").alias("root"), F.max((F.col("used") & F.col("hot")).cast("int")).alias("bound")).filter("bound = 1").drop("bound")
    over = materialize(over.join(sets.select("id", "label"), "id").withColumn("info", F.struct("band", "hot_keys", "root")), "over")

    @tidied
    def allocate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ("id", "root", "n", "key", "role"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        rows: list[list[np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            cols = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, dtype=np.int64) for i in range(5)]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(cols, kinds, strict=True)], names=names)

        held = 0
        for b in batches:
            for t, want, info in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                h, k = shingles(t), info["band"]
                if set_id(h) != want:
                    continue
                own = keys(h, k).view(np.int64)
                is_cold = ~np.isin(shortened(own.view(U), ranges), np.array(info["hot_keys"], dtype=np.int64))
                is_cold[keys_sent(h, k) :] = False  # nothing has met by those
                need, cold = most_differing(len(h), k) + 1, int(is_cold.sum())
                if cold >= need:
                    continue
                gone, at, sizes = deletions(h, k)
                # segments that others do not crowd stand for two, the largest ones: with an element less they are
                # least likely to look like what many sets have; one of one element could be empty in a partner
                able = np.flatnonzero(is_cold & (sizes > 1))
                enough = cold + len(able) >= need
                double = able[np.argsort(-sizes[able], kind="stable")][: need - cold if enough else 0]
                every = ((SAME, own[is_cold]), (WHOLE, own[double]), (LESS, gone[np.isin(at, double)]), (ANY_WHOLE, own), (ANY_LESS, gone), (ELEMENT, h.view(np.int64)))
                found, roles = np.concatenate([x for _, x in every]), np.repeat([r for r, _ in every], [len(x) for _, x in every])
                rows.append([np.full(len(found), want), np.full(len(found), info["root"]), np.full(len(found), len(h)), found, roles])
                held += len(found)
                if held > 100_000:
                    yield flush()
                    held = 0
        yield flush()

    w = small_batches(_read_again(docs, over, ["info"], id_col=id_col, text_col=text_col, longs=F.size("info.hot_keys") + 8)).mapInArrow(allocate, "id long, root long, n long, key long, role int")
    w = materialize(w.distinct(), "allocated")
    # allocation by cost: a set whose reduced segments would meet too many others is matched by its elements instead
    met = w.filter(F.col("role").isin(ANY_WHOLE, ANY_LESS)).groupBy("key", (F.col("role") == ANY_LESS).alias("less")).agg(F.count("*").alias("others"))
    probes = w.filter(F.col("role").isin(WHOLE, LESS, SAME)).withColumn("less", F.col("role") == WHOLE)
    # a set that has no segment standing for two cannot be matched by segments at all
    able = probes.filter(F.col("role") == WHOLE).select("id").distinct()
    cost = probes.join(able, "id", "left_semi").join(met, ["key", "less"], "left").groupBy("id").agg(F.coalesce(F.sum("others"), F.lit(0)).alias("cost"))
    by_segment = materialize(cost.filter(F.col("cost") <= DEAR).select("id"), "cheap")
    probe = materialize(probes.join(by_segment, "id", "left_semi").select("id", "root", "n", "key", "role"), "probes")
    # linked sets share one of their rarest elements: of n, at most n - ceil(3n/4) are not shared with a smaller set
    # and n - ceil(6n/7) not with a larger one; and behind the first one that they share, in the same order, both
    # have enough elements left to share
    elements = w.filter(F.col("role") == ELEMENT).join(by_segment, "id", "left_anti").dropDuplicates(["id", "key"])
    often = elements.groupBy("key").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "key"))
    rarest = elements.join(often, "key").withColumn("rank", rank).filter((F.col("rank") <= F.col("n") - F.ceil(0.75 * F.col("n")) + 1) & (F.col("df") > 1))
    rarest = materialize(rarest.select("id", "root", "n", "key", "rank"), "rarest")
    side = lambda rows, x, *more: rows.select("key", F.col("id").alias(x), F.col("root").alias(f"r{x}"), F.col("n").alias(f"n{x}"), *[F.col(c).alias(f"{c}_{x}") for c in more])
    differ = (F.col("a") != F.col("b")) & (F.col("ra") != F.col("rb")) & (3 * F.greatest("na", "nb") <= 4 * F.least("na", "nb"))
    for mine, theirs in ((WHOLE, ANY_LESS), (LESS, ANY_WHOLE), (SAME, ANY_WHOLE)):
        found = side(probe.filter(F.col("role") == mine), "a").join(side(w.filter(F.col("role") == theirs), "b"), "key").filter(differ)
        pairs = pairs.unionByName(found.select("a", "b"))
    smaller = side(rarest.filter(F.col("rank") <= F.col("n") - F.ceil(6 * F.col("n") / 7) + 1), "a", "rank")
    left = 1 + F.least(F.col("na") - F.col("rank_a"), F.col("nb") - F.col("rank_b"))
    found = smaller.join(side(rarest, "b", "rank"), "key").filter(differ & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & (7 * left >= 3 * (F.col("na") + F.col("nb"))))
    pairs = pairs.unionByName(found.select("a", "b"))
    return pairs


def _lean_links(docs: DataFrame, lean: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """The links (a, b) of the sets of lean (id, label, n, bitmap), written: each is held against all sets, in blocks of
    BROADCAST_LONGS elements. A hash puts hardly any set here; whatever their number, a block fits the driver."""

    @tidied
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(want, h.tobytes()) for t, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if set_id(h := shingles(t)) == want]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.binary())], names=["id", "h"])

    bodies = small_batches(_read_again(docs, lean.select("id", "label"), [], id_col=id_col, text_col=text_col)).mapInArrow(again, "id long, h binary").dropDuplicates(["id"])
    blocks = max(1, -(-int(lean.agg(F.sum("n")).first()[0] or 0) // BROADCAST_LONGS))
    bodies = materialize(bodies.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "lean")
    out = None
    for k in range(blocks):
        held = [(r.id, np.frombuffer(r.h, U)) for r in bodies.filter(F.col("block") == k).select("id", "h").collect()]
        order = np.argsort(np.concatenate([h for _, h in held])) if held else np.zeros(0, dtype=np.int64)
        shared = docs.sparkSession.sparkContext.broadcast((np.array([x for x, _ in held]), np.array([len(h) for _, h in held]), np.concatenate([h for _, h in held])[order] if held else order.astype(U), np.repeat(np.arange(len(held)), [len(h) for _, h in held])[order]))

        @tidied
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, sizes, elements, owner = shared.value
            for b in batches:
                pairs = []
                for t in b.column(0).to_pylist():
                    h = shingles(t)
                    lo, hi = np.searchsorted(elements, h), np.searchsorted(elements, h, side="right")
                    if not (hi > lo).any():
                        continue
                    both = np.bincount(np.concatenate([owner[x:y] for x, y in zip(lo, hi, strict=True) if y > x]), minlength=len(names))
                    own = set_id(h)
                    pairs += [(min(own, x), max(own, x)) for x in names[4 * both >= 3 * (len(h) + sizes - both)].tolist() if x != own]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], names=["a", "b"])

        found = small_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "a long, b long").distinct()
        found = materialize(found, "links")
        out = found if out is None else out.unionByName(found)
    return out


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False, thin: int = THIN) -> DataFrame:
    """(id_col, n_shingles, component_id): one row for each row of docs. If keyed, also row_key, set_id and root, which tells components apart where ids do not (null, or of several texts)."""
    m = materialize(describe(docs, id_col=id_col, text_col=text_col, keyed=keyed), "described")
    total = m.agg(F.sum("n").alias("n")).first().n or 0
    ranges = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total * 0.65) // TASK_KEYS))
    every = m.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("label"), F.max("n").alias("n"), F.max("bitmap").alias("bitmap"))
    grouped = materialize(signatures(docs, ranges, text_col=text_col, thin=thin).groupBy("p").applyInArrow(_group_sent, "a long, b long, key long, band int, spare int"), "grouped")
    how = {"id_col": id_col, "text_col": text_col}
    lean = grouped.filter("key is null and b is null").select(F.col("a").alias("id")).distinct()
    lean_links = _lean_links(docs, materialize(every.join(lean, "id", "left_semi"), "lean-sets"), **how) if lean.limit(1).count() else None
    touched = grouped.select(F.col("a").alias("id")).unionByName(grouped.filter("b is not null").select(F.col("b").alias("id")))
    if lean_links is not None:
        touched = touched.unionByName(lean_links.select(F.col("a").alias("id"))).unionByName(lean_links.select(F.col("b").alias("id")))
    sets = materialize(every.join(touched.distinct(), "id", "left_semi"), "touched")
    links = verify(docs, sets, grouped.filter("b is not null").select("a", "b"), **how)
    if lean_links is not None:
        links = links.unionByName(lean_links)
    roots = connected_components(links)
    # a set that can pass over all its keys of larger groups needs none of them
    held = F.count("*").over(Window.partitionBy("a", "band"))
    members = grouped.filter("key is not null").select("a", "key", "band", "spare").withColumn("held", held).filter("held > spare").drop("held")
    members = materialize(members, "members")
    for seed in range(STAR_ROUNDS + 1):
        left = _open(members, sets, roots)
        if not left.limit(1).count():
            break
        found = verify(docs, sets, _stars(left.filter("used"), seed) if seed < STAR_ROUNDS else _all_left(docs, sets, left, ranges, **how), **how)
        discard(left)
        if found.limit(1).count():
            links = links.unionByName(found)
            roots = connected_components(links)
    labels = roots.join(sets.select(F.col("id").alias("node"), "label"), "node")
    named = labels.groupBy("root").agg(F.min("label").alias("component"))
    named = materialize(labels.join(named, "root").select(F.col("node").alias("id"), "component", *["root"] * keyed), "named")
    own = m.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("label")).join(named, "id", "left")
    own = materialize(own.select("id", F.coalesce("component", "label").alias("component"), *[F.coalesce("root", "id").alias("root")] * keyed), "own")
    # two scans meet here, so that a hot id (very many exact copies) is split at run time
    out = m.join(own, "id", "left").select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), *["row_key", F.col("id").alias("set_id"), "root"] * keyed)
    return out


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, of the least id (null last); rows without shingles all stay. Rows are told apart by id and text, so null and repeated ids lose nothing."""
    found = materialize(join(docs, id_col=id_col, text_col=text_col, keyed=True).withColumnRenamed(id_col, "_id"), "joined")
    rows = found.filter("n_shingles > 0").groupBy("root", "_id", "set_id", "row_key").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "set_id", "row_key", "rows")).alias("first")
    one = rows.groupBy("root").agg(first).select(F.col("first._id").alias("_id"), F.col("first.row_key").alias("_key"), (F.col("first.rows") > 1).alias("_again"))
    every = found.filter("n_shingles = 0").select("_id", F.col("row_key").alias("_key"), F.lit(False).alias("_again")).distinct()
    keep = materialize(one.unionByName(every), "keep")
    again = bool(keep.filter("_again").limit(1).count())
    if keep.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keep = F.broadcast(keep)
    kept = docs.withColumn("_row_key", row_key(F.col(text_col))).join(keep, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_row_key") == F.col("_key")))
    if not again:
        return kept.select(docs.columns)
    # rows equal in id and text are copies of each other
    copies = kept.filter("_again").dropDuplicates(["_id", "_key"])
    return kept.filter("not _again").unionByName(copies).select(docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


#: The contract's rows, by all pairs that share a shingle and a walk along their links.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT DISTINCT rid, sh FROM (
  SELECT rid, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END) AS sh FROM d)),
k AS (SELECT rid, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS id FROM s GROUP BY 1),
r AS (SELECT id, min(rid) AS rid, any_value(n) AS n, min(doc_id) AS label FROM k JOIN d USING (rid) GROUP BY 1),
rs AS (SELECT r.rid, n, sh FROM r JOIN s USING (rid)),
p AS (SELECT a.rid AS x, b.rid AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c FROM rs a JOIN rs b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
cc AS (SELECT rid AS start, rid AS node FROM r UNION SELECT start, y FROM cc JOIN p ON cc.node = p.x),
c AS (SELECT node, min(label) AS component FROM cc JOIN r ON r.rid = cc.start GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM d LEFT JOIN k USING (rid) LEFT JOIN r ON r.id = k.id LEFT JOIN c ON c.node = r.rid
"""
