"""Secret scans over a worklist of decoded layers.

Every text is scanned as it stands (base findings), then its encoded segments are unwrapped: URL
escapes, backslash escapes, HTML character references of numbers, base64 (both alphabets, wrapped
lines joined) and hex, and inside binary payloads zlib, bare deflate, gzip, bzip2 and xz, and UTF-16. Layers of escapes and of
wrapped base64 go on a worklist, are scanned by the same rules and unwrapped in turn until nothing
new appears; each carries, for every character, the span of the original text that it came from, so
a finding of any depth is mapped back to code points of the whole text. A layer seen before (by its
content and the span it came from) is not entered again, which ends cycles: a blob that stands twice
in a text gives findings at both places.

All that one base64 or hex segment holds has that segment's span, so of its layers only the kinds
found are kept. They are scanned whole, whatever bytes they hold (those that are no UTF-8 are
replaced); compressed ones expand over all members until the input ends, in windows that overlap by
``OVERLAP`` characters, by the encoded segment that an edge would cut and by a gap inside an assignment.

Defined cases: null is empty text with no findings; equal rows give equal findings; very long texts are read
whole; findings at one place are ordered by kind, base ones first; an empty table gives no rows; other columns
are left out.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import functools
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, tidied

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
#: Maximal runs: a shorter run that fails holds no match that passes.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE = 8

ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX_BYTES = re.compile(r"(?:[0-9a-fA-F]{2}){16,}")
#: A line of wrapped base64 after the first; what follows it on the line ends the segment.
LINE = re.compile(r"""\r?\n[ \t]*([A-Za-z0-9+/_-]+={0,2})(?=[ \t]*(?:[\r\n"'`<,;)\]}\\]|\Z))""")
#: Bytes expanded at a time, characters read at a time, and how many of these are read again with the next ones.
PIECE, WINDOW, OVERLAP = 1 << 20, 4 << 20, 1 << 16
#: Of these an encoded segment may consist.
RUNNING = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\{};&#\r\n")


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end), in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _spread(out: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.full(len(out), start, dtype=np.int64), np.full(len(out), end, dtype=np.int64)


def _substitute(text: str, pattern: re.Pattern, decode) -> tuple[str, np.ndarray, np.ndarray] | None:
    """text with each match decoded, and for every character of the result its span in text."""
    parts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(text):
        new = decode(m)
        if new is None:
            continue
        gap = np.arange(at, m.start(), dtype=np.int64)
        s, e = _spread(new, m.start(), m.end())
        parts += [text[at : m.start()], new]
        starts += [gap, s]
        ends += [gap + 1, e]
        at = m.end()
    if not parts:
        return None
    gap = np.arange(at, len(text), dtype=np.int64)
    return "".join([*parts, text[at:]]), np.concatenate([*starts, gap]), np.concatenate([*ends, gap + 1])


def _url(text: str):
    if "%" not in text:
        return None
    # a run of escapes is one UTF-8 string, decoded character by character
    runs = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
    parts, starts, ends, at = [], [], [], 0
    for m in runs.finditer(text):
        raw = bytes.fromhex(m[0].replace("%", ""))
        gap = np.arange(at, m.start(), dtype=np.int64)
        parts.append(text[at : m.start()])
        starts.append(gap)
        ends.append(gap + 1)
        k = 0
        for c in raw.decode("utf-8", "replace"):
            n = len(c.encode()) if c != "\ufffd" else 1
            n = min(n, len(raw) - k)
            parts.append(c)
            starts.append(np.array([m.start() + 3 * k]))
            ends.append(np.array([m.start() + 3 * (k + n) if k + n < len(raw) else m.end()]))
            k += n
        at = m.end()
    if not at:
        return None
    gap = np.arange(at, len(text), dtype=np.int64)
    return "".join([*parts, text[at:]]), np.concatenate([*starts, gap]), np.concatenate([*ends, gap + 1])


def _escape(m: re.Match) -> str | None:
    digits, base = next(((g, 10 if i == 5 else 16) for i, g in enumerate(m.groups(), 1) if g), ("", 16))
    code = int(digits, base)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _decoder(head: bytes):
    """A decompressor for data that starts like this, or None."""
    if head[:2] == b"\x1f\x8b" or (len(head) > 1 and head[0] & 15 == 8 and head[:1] == b"\x78" and int.from_bytes(head[:2]) % 31 == 0):
        return zlib.decompressobj(zlib.MAX_WBITS | 32)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _headed(chunks: Iterator[bytes], start: bytes = b"", least: int = 6) -> tuple[bytes, Iterator[bytes]]:
    """The first bytes, `least` at least if there are so many, and the chunks that follow."""
    for more in chunks:
        start += more
        if len(start) >= least:
            break
    return start, chunks


def _encodings(head: bytes) -> list[str]:
    """UTF-8, and UTF-16 too by its mark or by zeros at every other byte of text in Latin letters."""
    even, odd = head[0:64:2], head[1:64:2]
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return ["utf-8", "utf-16"]
    if len(odd) >= 4 and odd.count(0) >= 0.7 * len(odd) and not even.count(0):
        return ["utf-8", "utf-16-le"]
    if len(odd) >= 4 and even.count(0) >= 0.7 * len(even) and not odd.count(0):
        return ["utf-8", "utf-16-be"]
    return ["utf-8"]


def _textual(head: bytes) -> bool:
    return len(_encodings(head)) > 1 or all(c >= 32 or c in b"\t\n\r" for c in head)


def _deflated(raw: bytes) -> Iterator[bytes] | None:
    """The pieces of a bare deflate stream that fills raw to its end, else None."""

    def pieces() -> Iterator[bytes]:
        d, data = zlib.decompressobj(-zlib.MAX_WBITS), raw
        while not d.eof:
            out = d.decompress(data, PIECE)
            data = d.unconsumed_tail
            if out:
                yield out
            elif not data:
                return

    d, data = zlib.decompressobj(-zlib.MAX_WBITS), raw
    try:
        while not d.eof:
            out = d.decompress(data, PIECE)
            data = d.unconsumed_tail
            if not d.eof and not out and not data:
                return None
    except zlib.error:
        return None
    return pieces() if not d.unused_data else None


def _members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """All members or streams expanded, piece by piece, until the input ends; what is not compressed comes as it stands."""
    rest, first = b"", True
    while True:
        rest, chunks = _headed(chunks, rest)
        data = rest if first else rest.lstrip(b"\0")  # members may be padded
        d, first = _decoder(data), False
        if d is None:
            if rest:
                yield rest
            yield from chunks
            return
        try:
            while not d.eof:
                out = d.decompress(data, PIECE)
                if out:
                    yield out
                data = getattr(d, "unconsumed_tail", b"")
                if not d.eof and _hungry(d, data, out):
                    if (data := next(chunks, None)) is None:
                        return
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            yield data
            yield from chunks
            return
        rest = d.unused_data


def _plain(raw: bytes) -> Iterator[bytes]:
    """The bytes under all compressed layers; a layer that comes again, as in a file that expands to itself, ends the way."""
    seen, make = set(), lambda: iter((raw,))
    while _decoder(_headed(make())[0]) is not None:
        h = hashlib.sha256()
        for x in make():
            h.update(x)
        if h.digest() in seen:
            break
        seen.add(h.digest())
        make = functools.partial(lambda make: _members(make()), make)
    return make()


def _hungry(d, data: bytes, out: bytes) -> bool:
    return d.needs_input if hasattr(d, "needs_input") else not data and len(out) < PIECE


def _complete(raw: bytes) -> bool:
    """Whether raw holds a whole compressed stream."""
    d, data = _decoder(raw), raw
    try:
        while d and not d.eof:
            out = d.decompress(data, PIECE)
            data = getattr(d, "unconsumed_tail", b"")
            if not d.eof and _hungry(d, data, out):
                return False
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return False
    return d is not None


def _lines(text: str, m: re.Match) -> list[tuple[int, int]]:
    """The lines of a wrapped segment that starts with the match m: as wide as the second one, but for the first and the last."""
    lines, width = [m.span()], m.end() - m.start()
    while text[lines[-1][1] - 1] != "=" and (n := LINE.match(text, lines[-1][1])):
        size = n.end() - n.start(1)
        if size > width and len(lines) > 1:
            break
        lines.append(n.span(1))
        if size < width:
            break
        width = size
    return lines


def _segments(text: str) -> Iterator[tuple[int, int, bytes, list[tuple[int, int]]]]:
    """(start, end, bytes, lines) of the base64 and hex segments. Wrapped base64 comes joined, with the spans of its lines, and line by line, unless it is one compressed stream."""
    done = skip = 0
    for m in BASE64.finditer(text):
        if m.start() >= done and len(lines := _lines(text, m)) > 1:
            done = lines[-1][1]
            raw = _unbased("".join(text[s:e] for s, e in lines))
            if _decoder(raw) is None:
                yield m.start(), done, raw, lines
            elif not _complete(_unbased(m[0])):
                yield m.start(), done, raw, []
                skip = done
        if m.start() >= skip:
            yield m.start(), m.end(), _unbased(m[0]), []
    for m in HEX_BYTES.finditer(text):
        yield m.start(), m.end(), bytes.fromhex(m[0]), []


def _by_line(raw: bytes, lines: list[tuple[int, int]]) -> tuple[str, np.ndarray, np.ndarray]:
    """The text of joined base64, each character with the span of the lines it came from."""
    try:
        out = raw.decode()
        sizes = np.array([1 if c < "\x80" else len(c.encode()) for c in out], dtype=np.int64)
    except UnicodeDecodeError:
        out, sizes = raw.decode("latin-1"), np.ones(len(raw), dtype=np.int64)
    last = np.cumsum(sizes)
    spans = np.array(lines, dtype=np.int64)
    edges = np.cumsum(spans[:, 1] - spans[:, 0])
    line = lambda at: np.minimum(np.searchsorted(edges, at, side="right"), len(lines) - 1)
    return out, spans[line((last - sizes) * 8 // 6), 0], spans[line(-(-last * 8 // 6) - 1), 1]


def _unbased(body: str) -> bytes:
    body = body.rstrip("=")
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))


def _unfinished(text: str) -> int:
    """Where the next window has to start: before its overlap, and before a gap or an encoded segment that may go on."""
    at = max(0, len(text) - OVERLAP)
    if text[at : at + 1] == " ":
        at = max(0, len(text[:at].rstrip(" ")) - LEAST_VALUE * 2)
    while at:
        if text[at - 1] in RUNNING:
            at -= 1
            continue
        gap = at
        while gap and text[gap - 1] in " \t":
            gap -= 1
        if gap == at or not gap or text[gap - 1] != "\n":
            break
        at = gap
    return at


def unwrap(text: str) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """text with its escapes decoded: the characters' start and end in text."""
    if (layer := _url(text)) is not None:
        yield layer
    if ("\\" in text or "&#" in text) and (layer := _substitute(text, ESCAPE, _escape)) is not None:
        yield layer


def kinds_in(raw: bytes, seen: set | None = None) -> set[int]:
    """The kinds of secrets anywhere below one segment, whose span they all share."""
    found: set[int] = set()
    seen = set() if seen is None else seen
    if (d := hashlib.sha256(raw).digest()) in seen:
        return found
    seen.add(d)
    make = functools.partial(_plain, raw)
    head = _headed(make(), least=64)[0]
    if _decoder(head) is None and not _textual(head) and _deflated(raw) is not None:
        make = functools.partial(_deflated, raw)
        head = _headed(make(), least=64)[0]
    for encoding in _encodings(head):
        _scan_layers(make(), encoding, found, seen)
    return found


def _scan_layers(chunks: Iterator[bytes], encoding: str, found: set[int], seen: set) -> None:
    """Adds the kinds found in the text of the chunks and below."""
    decoder, text, done, window = codecs.getincrementaldecoder(encoding)("replace"), "", False, WINDOW
    while not done and len(found) < len(KINDS):
        chunk = next(chunks, None)
        done = chunk is None
        text += decoder.decode(chunk or b"", done)
        if len(text) < window and not done:
            continue
        work, known = [text], {text}
        while work:
            layer = work.pop()
            found.update(k for _, k, _ in scan(layer))
            for _, _, inner, _ in _segments(layer):
                found |= kinds_in(inner, seen)
            for out, _, _ in unwrap(layer):
                if out not in known:
                    known.add(out)
                    work.append(out)
        text = text[_unfinished(text) :]
        window = max(WINDOW, 2 * len(text))


def findings(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base findings, and those that only decoded layers show; a span found as such already is not repeated."""
    base = scan(text)
    known, added = set(base), set()
    inside: dict[bytes, set[int]] = {}
    seen, work = {_place(text, None, None)}, [(text, None, None)]
    while work:
        layer, starts, ends = work.pop()
        if starts is not None:
            for s, k, e in scan(layer):
                span = (int(starts[s:e].min()), k, int(ends[s:e].max()))
                if span not in known:
                    added.add(span)
        below = list(unwrap(layer))
        for s, e, raw, lines in _segments(layer):
            if lines:
                below.append(_by_line(raw, lines))
                continue
            if raw not in inside:
                inside[raw] = kinds_in(raw)
            for k in inside[raw]:
                span = (s, k, e) if starts is None else (int(starts[s]), k, int(ends[e - 1]))
                if span not in known:
                    added.add(span)
        for out, s, e in below:
            if starts is not None and len(out):
                # through the layer above: the least start and largest end of what a character came from
                s, e = starts[s], ends[e - 1]
            place = _place(out, s, e)
            if place in seen:
                continue
            seen.add(place)
            work.append((out, s, e))
    # a base finding seen again through an escape elsewhere in the text keeps its place and is not new
    return base, sorted(added)


def _place(layer: str, starts: np.ndarray | None, ends: np.ndarray | None) -> bytes:
    """Tells layers apart by their content and by what they came from: a blob that stands twice is two layers."""
    h = hashlib.sha256(layer.encode())
    if starts is not None:
        h.update(starts.tobytes() + ends.tobytes())
    return h.digest()


def digest(base: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans: one row for each row of docs."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                base, added = findings(t or "")
                every = sorted([(s, k, 0, e) for s, k, e in base] + [(s, k, 1, e) for s, k, e in added])
                out.append((*[sum(x[1] == k for x in base) for k in range(3)], digest(base), ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, _, e in every)))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    out = small_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
