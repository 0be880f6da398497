"""Personal data by weak supervision.

Base spans (email, ip, card, phone) are found by fixed rules and always stay. Generators propose more
candidates: spelled-out addresses of mail, phone numbers without a plus, numbers and quads in the shape of
cards and ips that fail the base rules, national ids, IBANs, IPv6 and hardware addresses, handles, dates,
postal addresses, and names: titled ones, those behind a cue (dear, signed, ...) and, by a gazetteer learned
from the corpus (words that stand behind titles and cues, ``max_names`` of them), bare ones.

Labelers vote yes or no on every candidate, or abstain where a rule has no say on its kind: its checksum or value range, a gazetteer, words of its
kind near it, words of another meaning near it (version, order, isbn, ...), clean edges, a plausible length,
consistent grouping, and an improbable value (one digit throughout, counting up, a word that the text also
writes small). No labeler sees whether a span is a base one.

Expectation-maximisation (Dawid and Skene, two classes) estimates each labeler's reliability and each kind's
share from the votes. It runs on the histogram of (kind, base, votes) over the whole corpus, which is bounded
(kinds * 2 * 3^8), so it uses every candidate and still fits the driver; base spans are known to be personal
data and anchor the labelers. Its posteriors are the soft labels of the final span classifier, a logistic
regression over kind, votes, the span's shape and the words around it (hashed), trained on a sample of
``TRAIN_SPANS`` candidates at most, by a hash; nothing else is sampled. The classifier decides on every added
candidate; one that overlaps a base span is dropped, of others that overlap the leftmost, longest stays.

Defined cases: null is empty text; without candidates nothing is added and the model is empty; equal rows get
equal spans; of candidates at one place the longest, then the first kind counts; very long texts are read
whole; an empty table gives no rows; other columns are kept by mask_pii, whatever their names.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import discard, materialize
from .common import small_batches, table, tidied

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "national_id", "iban", "ipv6", "hardware", "handle", "date", "address", "name")
ACCEPT = 0.9
#: Candidates that train the classifier at most, and learned names.
TRAIN_SPANS, MAX_NAMES = 20_000, 50_000

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
HAS_DIGIT = re.compile(r"[0-9]")

#: Generators over texts that hold a digit.
LOOSE = tuple(
    (KINDS.index(kind), re.compile(pattern))
    for kind, pattern in (
        ("phone", r"(?<![\w+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])"),
        ("phone", r"(?<![\w+.-])0[0-9]{1,4}[\x20/-][0-9]{2,4}(?:[\x20-]?[0-9]{2,4}){1,3}(?![\w-])"),
        ("card", r"(?<![\w.+-])[0-9](?:[\x20.-]?[0-9]){12,18}(?![\w-])"),
        ("ip", r"(?<![\w.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![\w.]*[0-9])"),
        ("national_id", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
        ("national_id", r"(?<![\w-])[0-9]{8}[\x20-]?[A-Z](?![\w-])"),
        ("iban", r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
        ("date", r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![\w/-])"),
        ("address", r"(?<!\w)[0-9]{1,5}\x20(?:[A-Z][\w'-]+\x20){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Way|Place)(?!\w)"),
        ("address", r"(?<!\w)[0-9]{1,4},?\x20(?:rue|avenue|boulevard|place|chemin)\x20(?:(?:de|du|des|la|le)\x20)*[A-Z]\w+"),
        ("address", r"(?<!\w)[A-ZÄÖÜ][a-zäöüß]+(?:straße|strasse|weg|platz|allee|gasse)\x20[0-9]{1,4}[a-z]?(?!\w)"),
        ("address", r"(?<!\w)(?:Calle|Avenida|Plaza)\x20(?:(?:de|del|la|los|las)\x20)*[A-Z]\w+,?\x20[0-9]{1,4}(?!\w)"),
    )
)
HEXES = tuple((KINDS.index(kind), re.compile(pattern)) for kind, pattern in (("ipv6", r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9A-Fa-f])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])"), ("hardware", r"(?<![\w:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-])")))
SPELLED = re.compile(r"(?<!\w)[A-Za-z0-9._-]{2,64}\s?[\[(]at[\])]\s?[A-Za-z0-9-]{2,64}(?:\s?(?:[\[(]dot[\])]|\.)\s?[A-Za-z]{2,12})+(?!\w)")
HANDLE = re.compile(r"(?<![\w@./])@[A-Za-z][A-Za-z0-9_]{2,29}(?![\w@]|\.[A-Za-z])")
TITLES = frozenset("Mr Mrs Ms Dr Prof Herr Frau Mme Monsieur Madame Sr Sra Señor Señora".split())
CUES = frozenset("dear signed sincerely regards contact patient client name called hallo liebe lieber cher chère querido querida".split())
PHRASES = ("my name is ", "i am ", "mein name ist ", "je m'appelle ", "me llamo ")
_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?"
#: Up to four words that begin large.
CAPITALS = re.compile(rf"(?<!\w){_CAP}(?:\x20{_CAP}){{0,3}}(?!\w)")
BEFORE = re.compile(r"(\w+)(?: is)?[:,.]?\x20$")
NAME = KINDS.index("name")

#: Gazetteers of the labelers.
ENDINGS = frozenset("com org net edu gov info de fr es uk eu io co".split())
GIVEN = frozenset("james mary john anna peter maria paul laura david sarah thomas julia jean marie pierre hans klaus juan carlos jose elena".split())
NEAR = {
    "email": ("mail", "contact", "write", "address", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "cell", "contact"),
    "national_id": ("ssn", "social", "security", "tax", "identity", "dni", "passport"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ipv6": ("ip", "host", "server", "address", "login"),
    "hardware": ("mac", "device", "adapter", "ethernet"),
    "handle": ("follow", "twitter", "instagram", "handle", "profile", "user"),
    "date": ("born", "birth", "dob", "geboren", "geburtsdatum", "né le", "née le", "nacid", "nacimiento"),
    "address": ("live", "address", "home", "reside", "wohn", "adresse", "habite", "vive", "dirección"),
    "name": ("name", "patient", "client", "signed", "dear", "contact", "born", "regards"),
}
AGAINST = ("version", "release", "build", "order", "invoice", "isbn", "sku", "model", "part no", "serial", "ticket", "published", "updated", "chapter", "section", "catalog", "batch", "lot ")
WINDOW = 40
LABELERS = 8
#: Hashed features of a span's shape and of the words around it.
BUCKETS = 1024
WORDS = re.compile(r"\w+")
_DNI = "TRWAGMYFPDXBNJZSQVHLCKE"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end), by kind and then start."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


def _loose(text: str, names: frozenset) -> list[tuple[int, int, int]]:
    out = []
    if HAS_DIGIT.search(text):
        for kind, pattern in LOOSE:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    if ":" in text or "-" in text:
        for kind, pattern in HEXES:
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    if "at]" in text or "at)" in text:
        out += [(0, m.start(), m.end()) for m in SPELLED.finditer(text)]
    if "@" in text:
        out += [(KINDS.index("handle"), m.start(), m.end()) for m in HANDLE.finditer(text)]
    out += [(NAME, s, e) for s, e, cued in _capitals(text) if cued or (" " in text[s:e] and text[s:e].split(" ", 1)[0].lower() in names)]
    return out


def _capitals(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether behind a title or cue) of up to three words that begin large."""
    for m in CAPITALS.finditer(text):
        start, end = m.span()
        words = m[0].split(" ")
        cued = False
        if len(words) > 1 and (words[0] in TITLES or words[0].lower() in CUES):
            start, cued, words = start + len(words[0]) + 1, True, words[1:]
        elif start:
            before = text[max(0, start - 24) : start]
            if before[-1] == " ":
                b = BEFORE.search(before)
                cued = bool(b) and (b[1] in TITLES or b[1].lower() in CUES) or before.lower().endswith(PHRASES)
        yield start, start + len(" ".join(words[:3])), cued


def cued_names(text: str) -> Iterator[str]:
    """The words of the names behind titles and cues."""
    for start, end, cued in _capitals(text):
        if cued:
            yield from text[start:end].lower().split(" ")


def _valid(name: str, span: str, digits: str) -> int:
    if name == "card":
        return int(luhn(digits))
    if name == "iban":
        s = span.replace(" ", "")
        return int(int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1)
    if name == "ip":
        return int(all(int(p) <= 255 for p in span.split(".")) and not span.startswith(("0.", "255.")))
    if name == "ipv6":
        try:
            return int(not ipaddress.IPv6Address(span).is_unspecified)
        except ValueError:
            return 0
    if name == "national_id":
        if span[-1].isalpha():
            return int(_DNI[int(digits) % 23] == span[-1])
        return int(span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00" and span[7:] != "0000")
    if name == "date":
        y, m, d = (span.split("-")) if "-" in span else reversed(re.split(r"[./]", span))
        return int(1900 <= int(y) <= 2030 and (1 <= int(m) <= 12 and 1 <= int(d) <= 31 or 1 <= int(d) <= 12 and 1 <= int(m) <= 31))
    return 2


def _votes(text: str, small: frozenset, names: frozenset, kind: int, start: int, end: int) -> int:
    """The eight votes (0 no, 1 yes, 2 abstains) as one number in base 3. small: words that the text writes small."""
    span, name = text[start:end], KINDS[kind]
    digits = NOT_DIGIT.sub("", span)
    words = [w.lower() for w in WORDS.findall(span)] if name == "name" else ()
    if name == "email":
        gazetteer = int(re.split(r"[^A-Za-z]+", span)[-1].lower() in ENDINGS)
    elif name == "name":
        gazetteer = int(words[0] in names)
    else:
        gazetteer = 2
    around = f"{text[max(0, start - WINDOW) : start]} {text[end : end + WINDOW // 2]}".lower()
    near = int(any(w in around for w in NEAR[name]))
    against = int(not any(w in around for w in AGAINST))
    edges = int(not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum()))
    n = len(digits)
    length = {"card": int(n in (13, 14, 15, 16, 19)), "phone": int(9 <= n <= 13), "email": int(6 <= len(span) <= 100), "ip": int(7 <= len(span) <= 15), "iban": int(15 <= len(span.replace(" ", "")) <= 34), "name": int(1 <= len(words) <= 3 and min(map(len, words), default=0) >= 2)}.get(name, 2)
    separators = set(re.sub(r"[0-9()+]", "", span)) if name in ("card", "phone") else set()
    grouping = 2 if not separators else int(len(separators - {" "}) <= 1)
    if name == "name":
        odd = 0 if any(w in small for w in words) else 1
    elif n >= 8:
        odd = int(len(set(digits)) > 2 and digits not in "01234567890123456789" and digits not in "98765432109876543210")
    else:
        odd = 2
    code = 0
    for v in (_valid(name, span, digits), gazetteer, near, against, edges, length, grouping, odd):
        code = 3 * code + v
    return code


def _bucket(what: str) -> int:
    return xxhash.xxh3_64_intdigest(what) % BUCKETS


def _context(text: str, kind: int, start: int, end: int) -> list[int]:
    """Four hashed features: the span's shape, the two words before it, the word after it."""
    shape = re.sub(r"(.)\1+", r"\1", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in text[start:end]))
    before = [re.sub(r"[0-9]", "#", w) for w in WORDS.findall(text[max(0, start - WINDOW) : start].lower())[-2:]]
    after = WORDS.findall(text[end : end + WINDOW].lower())[:1]
    return [_bucket(f"s{kind}{shape}"), *[_bucket(f"b{kind}{w}") for w in (*[""] * (2 - len(before)), *before)], _bucket(f"a{kind}{after[0] if after else ''}")]


def candidates(text: str, names: frozenset = GIVEN) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(kind, start, end, base, votes, context); added candidates overlap neither base spans nor each other."""
    base = base_spans(text)
    loose = _loose(text, names)
    if not base and not loose:
        return []
    small = frozenset(w for w in WORDS.findall(text) if w.islower()) if any(k == NAME for k, _, _ in loose) else frozenset()
    describe = lambda k, s, e: (_votes(text, small, names, k, s, e), _context(text, k, s, e))
    out = [(k, s, e, True, *describe(k, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    last, at = 0, 0
    for k, s, e in sorted(loose, key=lambda x: (x[1], -x[2], x[0])):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        # base spans of different kinds may nest, so look at each that begins before e
        if s < last or any(a < e and s < b for a, b in _from(taken, at, e)):
            continue
        out.append((k, s, e, False, *describe(k, s, e)))
        last = e
    return out


def _from(spans: list[tuple[int, int]], at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < len(spans) and spans[at][0] < end:
        yield spans[at]
        at += 1


def unpack(codes: np.ndarray) -> np.ndarray:
    """Votes of each code, one column a labeler."""
    return np.stack([codes // 3**i % 3 for i in range(LABELERS - 1, -1, -1)], axis=1) if len(codes) else np.zeros((0, LABELERS), dtype=np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


#: Beta priors (yes, no) of the labelers' sensitivities and (no, yes) of their specificities, in the order of _votes: what fails a
#: checksum is hardly ever personal data, what stands beside "version" or "isbn" neither; a cue may well be missing.
SENSITIVE = np.array([(200, 1), (4, 2), (2, 2), (200, 1), (20, 1), (20, 1), (20, 1), (20, 1)], dtype=float)
SPECIFIC = np.array([(8, 2), (4, 2), (8, 2), (2, 8), (2, 8), (2, 8), (2, 8), (2, 4)], dtype=float)


class Votes:
    """Dawid and Skene's model by expectation-maximisation. histogram: (kind, base, votes) -> count."""

    def __init__(self, histogram: dict[tuple[int, bool, int], int], rounds: int = 500):
        self.keys = sorted(histogram)
        n = np.array([histogram[k] for k in self.keys], dtype=float)
        kind = np.array([k for k, _, _ in self.keys], dtype=int)
        base = np.array([b for _, b, _ in self.keys], dtype=bool)
        votes = unpack(np.array([v for _, _, v in self.keys], dtype=np.int64))
        yes, no = (votes == 1).astype(float), (votes == 0).astype(float)
        self.sensitivity, self.specificity, self.prior = np.full(LABELERS, 0.8), np.full(LABELERS, 0.6), np.full(len(KINDS), 0.5)
        # base spans count as much as the loose candidates at most: they teach the labelers, and the loose ones too
        weight = np.where(base, np.minimum(1.0, max(1.0, n[~base].sum()) / max(1.0, n[base].sum())), 1.0) * n
        post = np.where(base, 1.0, 0.0)
        for _ in range(rounds if len(self.keys) else 0):
            one = np.log(self.prior[kind]) + yes @ np.log(self.sensitivity) + no @ np.log(1 - self.sensitivity)
            zero = np.log(1 - self.prior[kind]) + yes @ np.log(1 - self.specificity) + no @ np.log(self.specificity)
            new = np.where(base, 1.0, sigmoid(one - zero))
            w1, w0 = weight * new, weight * (1 - new)
            self.sensitivity = np.clip((w1 @ yes + SENSITIVE[:, 0]) / (w1 @ (yes + no) + SENSITIVE.sum(axis=1)), 0.01, 0.99)
            # a labeler that says yes to everything says nothing, but none is worse than chance
            self.specificity = np.clip(np.maximum((w0 @ no + SPECIFIC[:, 0]) / (w0 @ (yes + no) + SPECIFIC.sum(axis=1)), 1 - self.sensitivity), 0.01, 0.99)
            loose = np.where(base, 0.0, n)
            self.prior = np.array([((loose * new * (kind == k)).sum() + 1) / ((loose * (kind == k)).sum() + 2) for k in range(len(KINDS))])
            moved = np.abs(new - post).max(initial=0)
            post = new
            if moved < 1e-9:
                break
        self.posterior = dict(zip(self.keys, post.tolist(), strict=True))


#: Features of a candidate: one, its kind, each labeler's yes or no, and four of its context.
DENSE = 1 + len(KINDS) + 2 * LABELERS
ACTIVE = 1 + 1 + LABELERS + 4
NONE = DENSE + BUCKETS


def features(kinds: np.ndarray, codes: np.ndarray, context: np.ndarray) -> np.ndarray:
    """The places of each candidate's ACTIVE features; an abstention has the place NONE, of weight 0."""
    votes = unpack(codes)
    at = 1 + len(KINDS) + 2 * np.arange(LABELERS) + (votes == 1)
    return np.concatenate([np.zeros((len(kinds), 1), dtype=np.int64), 1 + kinds[:, None], np.where(votes == 2, NONE, at), DENSE + context.reshape(len(kinds), 4)], axis=1)


def train(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 400) -> np.ndarray:
    """Ridge logistic regression on soft labels, by accelerated gradient steps. The context's weights are held smaller than the votes'."""
    w = np.zeros(NONE + 1)
    ridge = np.where(np.arange(NONE + 1) < DENSE, 0.02, 0.5)
    ahead, total = w.copy(), max(1.0, n.sum())
    rate = 4.0 / ACTIVE
    for k in range(steps if len(x) else 0):
        error = n * (sigmoid(ahead[x].sum(axis=1)) - y) / total
        grad = np.bincount(x.ravel(), weights=np.repeat(error, x.shape[1]), minlength=NONE + 1) + ridge * ahead / total
        new = ahead - rate * grad
        new[NONE] = 0.0
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


class Model:
    """names: the gazetteer; votes: EM's estimates; weights: the span classifier's, empty without candidates."""

    def __init__(self, names: frozenset = GIVEN, votes: Votes | None = None, weights: np.ndarray | None = None):
        self.names, self.votes, self.weights = names, votes or Votes({}), weights

    def probability(self, found: list[tuple]) -> np.ndarray:
        """Of each candidate to be personal data."""
        if self.weights is None or not found:
            return np.zeros(len(found))
        x = features(np.array([c[0] for c in found]), np.array([c[4] for c in found]), np.array([c[5] for c in found]))
        return sigmoid(self.weights[x].sum(axis=1))

    def spans(self, text: str, threshold: float = ACCEPT) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans and added ones."""
        found = candidates(text, self.names)
        loose = [c for c in found if not c[3]]
        return [c[:3] for c in found if c[3]], [c[:3] for c, p in zip(loose, self.probability(loose), strict=True) if p >= threshold]


def learn_names(docs: DataFrame, *, text_col: str = "text", max_names: int = MAX_NAMES) -> frozenset:
    """GIVEN and the words that stand behind titles and cues twice or more in the corpus, the most frequent max_names."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for t in b.column(0).to_pylist():
                found.update(cued_names(t or ""))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    counts = small_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return GIVEN | {r.word for r in counts.filter("n > 1").orderBy(F.desc("n"), "word").limit(max_names).collect()}


def fit(docs: DataFrame, *, text_col: str = "text", max_names: int = MAX_NAMES, train_spans: int = TRAIN_SPANS) -> Model:
    """Gazetteer, EM and classifier over the candidates of all texts."""
    names = learn_names(docs, text_col=text_col, max_names=max_names)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int32()))
        for b in batches:
            rows = [(k, base, v, x) for t in b.column(0).to_pylist() for k, _, _, base, v, x in candidates(t or "", names)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["kind", "base", "votes", "context"])

    # a few dozen bytes a candidate, written once: for the histogram and for the sample
    found = small_batches(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "kind int, base boolean, votes int, context array<int>")
    found = materialize(found.groupBy("kind", "base", "votes", "context").agg(F.count("*").alias("n")), "candidates")
    votes = Votes({(r.kind, r.base, r.votes): r.n for r in found.groupBy("kind", "base", "votes").agg(F.sum("n").alias("n")).collect()})
    chance = train_spans / max(1, found.count())
    h = F.pmod(F.xxhash64("kind", "base", "votes", "context"), F.lit(1 << 30))
    # twice the chance and then a limit by the same hash: at most train_spans rows, whatever the table
    sample = found.filter(h < min(2.0, 2 * chance) * float(1 << 30)).orderBy(h, "kind", "votes", F.col("context").cast("string")).limit(train_spans).collect()
    discard(found)
    if not sample:
        return Model(names, votes)
    x = features(np.array([r.kind for r in sample]), np.array([r.votes for r in sample]), np.array([r.context for r in sample]))
    y = np.array([votes.posterior[r.kind, r.base, r.votes] for r in sample])
    return Model(names, votes, train(x, y, np.log1p(np.array([r.n for r in sample], dtype=float))))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_pii(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                base, added = shared.value.spans(t or "")
                out.append((*[sum(x[0] == k for x in base) for k in range(4)], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + added)))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = (*[pa.int64()] * 4, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    out = small_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)


def masked(text: str, model: Model) -> str:
    """text with each span replaced by its kind in square brackets; of overlapping spans the union goes, under the first one's kind."""
    base, added = model.spans(text)
    parts, at, open_end = [], 0, 0
    for s, e, k in sorted((s, e, k) for k, s, e in base + added):
        if s >= open_end:
            parts += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = open_end = max(open_end, e)
    return "".join([*parts, text[at:]]) if parts else text


def mask_pii(docs: DataFrame, model: Model, *, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """docs with personal data masked in the text (and its length, where docs has that column)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else None

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            old = cols[at].to_pylist()
            new = [t and masked(t, shared.value) for t in old]
            cols[at] = pa.array(new, cols[at].type)
            if size_at is not None:
                sizes = [len(n) if n is not o else k for o, n, k in zip(old, new, cols[size_at].to_pylist(), strict=True)]
                cols[size_at] = pa.array(sizes, cols[size_at].type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return small_batches(docs).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit(docs))
