"""Small cases and brute force for each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import bz2
import gzip
import hashlib
import io
import lzma
import random
import re
import tarfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontaminate, html_extract, jaccard_join, language_id, media, packing, pii, secret_scan, sharding, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n string, hits string"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "y", "z") for i, t in texts], SCHEMA)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text): prose, exact and near copies, shared passages, nulls, empties, a long text, repeated rows."""
    rng = random.Random(7)
    out = [(0, None), (1, ""), (2, " \t"), (3, "one two"), (4, "one two"), (5, "ONE two"), (6, "!!! ???")]
    base = [prose(rng, rng.randrange(20, 300), 4000) for _ in range(40)]
    passage = prose(rng, 70, 4000)
    k = 10
    for t in base:
        out.append((k, t))
        k += 1
    for t in base[:12]:
        w = t.split()
        for _ in range(4):
            c = list(w)
            for _ in range(rng.randrange(0, max(1, len(w) // 25))):
                c[rng.randrange(len(c))] = "zz"
            out.append((k, " ".join(c)))
            k += 1
    for _ in range(90):
        out.append((k, f"{prose(rng, rng.randrange(5, 40), 4000)} {passage} {prose(rng, rng.randrange(5, 40), 4000)}"))
        k += 1
    out.append((k, prose(rng, 6000, 4000)))
    out += [out[12], out[12]]
    return out


def test_decontamination_matches_brute_force(spark, corpus):
    bench = [(0, " ".join(corpus[8][1].split()[3:30])), (1, "one two"), (2, None), (3, "?!"), (10, " ".join(corpus[8][1].split()[10:25])), (11, corpus[9][1])]
    b = spark.createDataFrame(bench, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    want = []
    for i, t in corpus:
        w, hit, items = low(t), set(), set()
        for item, bt in bench:
            g = low(bt)
            n = min(13, len(g))
            grams = {tuple(g[k : k + n]) for k in range(len(g) - n + 1)} if n else set()
            for at in range(len(w) - n + 1 if n else 0):
                if tuple(w[at : at + n]) in grams:
                    hit |= set(range(at, at + n))
                    items.add(str(item))
        want.append((i, len(w), len(hit), len(items), ",".join(sorted(items)), bool(hit) and 20 * len(hit) >= len(w)))
    d = docs_of(spark, corpus)
    for most in (100_000, 0):
        got = decontaminate.contamination(d, b, max_broadcast_windows=most)
        assert sorted((r.id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"]), r.contaminated) for r in got.collect()) == sorted(want)
    kept = decontaminate.remove_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in want if not x[5])
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(d, b).collect()}
    clean = {x[0]: x for x in want if not x[2]}
    assert all(cut[i] == t for i, t in corpus if i in clean)
    assert all(len(low(cut[x[0]])) == x[1] - x[2] for x in want)
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    assert not decontaminate.contamination(d, b.limit(0)).filter("contaminated").count()


def test_jaccard_join_matches_brute_force(spark, corpus):
    def brute(rows):
        low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for i, t in rows}
        sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
        parent = {i: i for i in sets}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        ids = sorted(sets)
        for x, a in enumerate(ids):
            for b in ids[x + 1 :]:
                both = len(sets[a] & sets[b])
                if both and 4 * both >= 3 * len(sets[a] | sets[b]):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
        return {i: (len(sets[i]), root(i)) for i in ids}

    d = docs_of(spark, corpus)
    want = brute(corpus)
    got = jaccard_join.join(d).collect()
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    # keys that two sets of a batch share are thinned there
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(d, thin=2).collect()} == want
    kept = jaccard_join.deduplicate(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert jaccard_join.join(d.limit(0)).count() == 0


def test_jaccard_join_of_sets_with_few_segments(spark, corpus):
    """Sets that no key is sure to find are marked and held against all others, in blocks."""
    import pyarrow as pa

    h = np.array([5, 9], dtype=np.uint64)
    row = {"p": 0, "ids": np.array([7, 8], dtype=np.int64).tobytes(), "bands": bytes(2), "spare": np.array([-1, 0], dtype=np.int32).tobytes(), "counts": np.array([1, 1], dtype=np.uint32).tobytes(), "keys": jaccard_join.packed(h), "centres": None}
    out = jaccard_join._group(pa.table({n: pa.array([row[n]], t) for n, t in jaccard_join._PACKED})).to_pylist()
    assert [r["a"] for r in out if r["b"] is None and r["key"] is None] == [7]
    d = docs_of(spark, corpus)
    sets = jaccard_join.describe(d).filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("label"), F.max("n").alias("n"), F.max("bitmap").alias("bitmap")).cache()
    own = {r.id: set(jaccard_join.shingles(dict(corpus)[r.label]).tolist()) for r in sets.collect()}
    some = sets.filter(F.pmod("id", F.lit(3)) == 0)
    lean = {r.id for r in some.collect()}
    want = {(min(a, b), max(a, b)) for a in lean for b in own if a != b and 4 * len(own[a] & own[b]) >= 3 * len(own[a] | own[b])}
    for most in (jaccard_join.BROADCAST_LONGS, 2_000):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(jaccard_join, "BROADCAST_LONGS", most)
            got = jaccard_join._lean_links(d, some, id_col="doc_id", text_col="text").distinct().collect()
        assert {(r.a, r.b) for r in got} == want and want


def test_jaccard_join_sends_the_keys_that_find_links(spark, corpus):
    """Of two linked sets' first keys enough agree that neither can pass over all of them, and no more than those travel."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 20, 33, 60, 200, 333, 900, 4000):
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone = rng.integers(0, n // 7 + 1)
            y = np.unique(np.concatenate([x[gone:], rng.integers(0, 1 << 63, rng.integers(0, max(0, n - gone) // 7 + 1), dtype=np.uint64)]))
            if not len(y) or not jaccard_join.linked(x, y):
                continue
            k = jaccard_join.band(min(len(x), len(y)))
            sent = [jaccard_join.keys(h, k)[: jaccard_join.keys_sent(h, k)] for h in (x, y)]
            spare = [len(s) - jaccard_join.most_differing(len(h), k) - 1 for s, h in zip(sent, (x, y), strict=True)]
            assert len(np.intersect1d(*sent)) > max(spare) or min(spare) < 0  # those are held against all sets
    d = docs_of(spark, corpus)
    rows = jaccard_join.signatures(d, 50).toArrow().to_pylist()
    sets = [h for _, t in corpus if len(h := jaccard_join.shingles(t))]
    needed = sum(jaccard_join.most_differing(len(h), k) + 1 + 2 for h in sets for k in jaccard_join.bands_of(len(h)))
    assert sum(len(r["keys"]) for r in rows if r["centres"] is None) <= 4 * 1.5 * needed


def test_deduplicate_null_and_repeated_ids(spark):
    rng = random.Random(8)
    t = [prose(rng, 60, 4000) for _ in range(8)]
    near = t[0] + " more"
    rows = [(None, t[1]), (None, t[2]), (None, t[2]), (None, None), (None, ""), (None, ""), (1, t[0]), (2, near), (2, t[3]), (3, t[4]), (3, t[5]), (4, t[6]), (4, t[6]), (None, near), (None, t[7]), (None, t[7] + " end"), (5, t[2] + " x")]
    got = sorted(((r.doc_id or 0, r.text or "") for r in jaccard_join.deduplicate(docs_of(spark, rows)).collect()))
    null = [x for i, x in got if not i]
    assert null[:3] == ["", "", ""] and t[1] in null and len(null) == 5 and sum(x.startswith(t[7]) for x in null) == 1
    assert got[5:] == sorted([(1, t[0]), (2, t[3]), (3, t[4]), (3, t[5]), (4, t[6]), (5, t[2] + " x")])


def test_jaccard_join_with_crowded_keys(spark, corpus, monkeypatch):
    """Small limits drive the crowded sets through stars, passing over, deletions and rarest elements."""
    want = {r.doc_id: r.component_id for r in jaccard_join.join(docs_of(spark, corpus)).collect()}
    monkeypatch.setattr(jaccard_join, "HOT", 2)
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 0)
    for dear in (0, 10**9):
        monkeypatch.setattr(jaccard_join, "DEAR", dear)
        assert {r.doc_id: r.component_id for r in jaccard_join.join(docs_of(spark, corpus)).collect()} == want


@pytest.mark.parametrize("hot", [100_000, 3])
def test_repeated_passages_match_brute_force(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot)
    words = {i: (t or "").encode().translate(suffix_dedup.LOWER_BYTES).split() for i, t in corpus}
    where: dict = {}
    for i, w in words.items():
        for s in range(len(w) - 49):
            where.setdefault(tuple(w[s : s + 50]), set()).add(i)
    want = {}
    for i, w in words.items():
        marks = set()
        drop = set()
        for s in range(len(w) - 49):
            owners = where[tuple(w[s : s + 50])]
            if len(owners) > 1:
                marks |= set(range(s, s + 50))
                if min(owners) < i:
                    drop |= set(range(s, s + 50))
        if marks:
            want[i] = (len(w), len(marks), len(drop))
    d = docs_of(spark, corpus)
    got = {r.doc_id: (r.n_words, r.n_repeated, r.n_drop) for r in suffix_dedup.passages(d).collect()}
    assert got == want
    left = {r.doc_id: len((r.text or "").split()) for r in suffix_dedup.drop_passages(d).collect()}
    assert all(left[i] == n - k for i, (n, _, k) in want.items())
    assert suffix_dedup.passages(d.limit(0)).count() == 0


def test_language(spark):
    rng = random.Random(3)
    vocabulary = {k: [f"{k}{a}{b}" for a in "aeiou" for b in "klmn"] for k in ("xa", "yo")}
    rows = [(i, " ".join(rng.choice(vocabulary[k]) for _ in range(30)), k, "s", 0, "", "", "") for i, k in enumerate(["xa", "yo"] * 40)]
    d = spark.createDataFrame([*rows, (900, None, "xa", "", 0, "", "", ""), (901, "12 -- ²", "yo", "", 0, "", "", ""), (902, "xaak", None, "", 0, "", "", ""), (903, "yoyoyo", None, "", 0, "", "", "")], SCHEMA)
    model = language_id.fit(d.filter(~language_id.held_out("doc_id")))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(d, model).collect()}
    assert all(got[r[0]][0] == r[2] for r in rows) and got[902][0] == "xa" and got[903][0] == "yo"
    assert got[900] == got[901] == ("und", 0.0)
    kept = language_id.keep_identified(d, model, 0.3)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == set(got) - {900, 901}
    none = language_id.fit(d.limit(0))
    assert {r.lang_pred for r in language_id.identify(d, none).collect()} == {"und"}


def test_language_held_out_and_plain(spark):
    """Accuracy on the rows that the model has not seen, and every answer once more by the plain rule."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(d.filter(~language_id.held_out("doc_id")))
    got = language_id.identify(d, model).join(d.select("doc_id", "text", "lang", language_id.held_out("doc_id").alias("out")), "doc_id").collect()
    unseen = [r for r in got if r.out]
    assert len(unseen) > 200 and sum(r.lang_pred == r.lang for r in unseen) >= 0.99 * len(unseen)

    def plain(word):
        if word in model.words:
            return model.word_scores[model.words[word]].astype(float)
        for n in range(5, 0, -1):
            rows, scores = model.levels[n]
            padded = f"\x02{word}\x03" if n > 1 else word
            known = [rows[padded[i : i + n]] for i in range(len(padded) - n + 1) if padded[i : i + n] in rows]
            if known:
                return scores[known].astype(float).mean(axis=0)
        return np.zeros(len(model.langs))

    for r in got[:150]:
        own = np.array([plain(w) for w in re.findall(r"[^\W\d_]+", r.text.lower())])
        best = int(own.sum(axis=0).argmax())
        each = np.exp(own - own.max(axis=1, keepdims=True))
        assert r.lang_pred == model.langs[best] and abs(r.score - (each[:, best] / each.sum(axis=1)).mean()) < 1e-4
    score = model.scorer()
    one = {k: " ".join(x.text for x in got if x.lang == k)[:4000] for k in ("en", "fr")}
    assert score(one["en"])[1] > 0.8 and score(one["en"] + " " + one["fr"])[1] < 0.7 and score("привет мир")[1] < 0.4
    blank = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id: r.lang for r in language_id.keep_identified(blank, model, 0.0).collect()} == {r.doc_id: r.lang_pred for r in got}
    very_long = docs_of(spark, [(1, one["fr"] * 500), (1, one["fr"] * 500)], None)
    assert [r.lang_pred for r in language_id.identify(very_long, model).collect()] == ["fr", "fr"]


def test_language_of_few_rows(spark):
    """Frequent languages do not crowd a rare one out of full tables; all its pieces stand once only."""
    assert language_id.least_level({5: 2, 2: 3, 1: 10}, 10) == (1, 0.5) and language_id.least_level({5: 2, 2: 3}, 5) == (0, 0.0)
    assert (language_id.MAX_WORDS, language_id.MAX_GRAMS) == (200_000, 200_000)
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(7))
    often = {k: [word(c) for _ in range(120)] for k, c in (("aa", "abcdefgh"), ("bb", "ijklmnop"))}
    rare = [word("qrstuvwxyz") for _ in range(40)]
    rows = [(i, " ".join(rng.choice(often[k]) for _ in range(60)), k) for i, k in enumerate(["aa", "bb"] * 60)] + [(500, " ".join(rare), "rr")]
    d = spark.createDataFrame([(i, t, k, "s", 0, "", "", "") for i, t, k in rows], SCHEMA)
    model = language_id.fit(d, max_words=150, max_grams=1800)
    assert set(rare) <= set(model.words) and len(model.words) <= 150 and sum(len(r) for r, _ in model.levels.values()) <= 1860
    score = model.scorer()
    assert all(score(" ".join(rng.sample(rare, 5)))[0] == "rr" for _ in range(20)) and all(score(t)[0] == k for _, t, k in rows)


def test_secrets(spark):
    inner = "the password = 'abcdefghij1' is"
    cases = {
        0: None, 1: "", 2: 'token: "abcdefgh" secret=short AKIAABCDEFGHIJKL ' + "a" * 32, 3: base64.b64encode(inner.encode()).decode(),
        4: base64.b64encode(zlib.compress(inner.encode())).decode(), 5: "%70assword%3Dabcdefghij", 6: "\\u0074oken=abcdefghi1",
        7: base64.b64encode(base64.b64encode(inner.encode())).decode(), 8: "é PASSWD: abcdefgh api_key='0123456789ab'", 9: "K tokenſ=abcdefghij",
    }
    got = {r.doc_id: r for r in secret_scan.scan_secrets(docs_of(spark, list(cases.items()))).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[0].base_sha256 == got[1].base_sha256 == empty and got[0].spans == ""
    assert (got[2].n_assign, got[2].n_access, got[2].n_hex) == (1, 1, 1)
    for i in (3, 4, 5, 6, 7):
        assert got[i].n_assign == 0 and got[i].spans.startswith("assign:0:"), i
    assert got[8].n_assign == 1 and got[8].spans.startswith("assign:")
    # the plain rule, match by match, on random texts
    rng = random.Random(5)
    parts = ["password", "Secret", "token", "=", ":", " ", '"', "abcdefgh", "abc", "api_key", "apikey", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef" * 5, "x"]
    rule = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for _ in range(500):
        t = "".join(rng.choice(parts) for _ in range(20))
        want = [(m.start(), 0, m.end()) for m in rule.finditer(t) if len(m[2]) >= 8]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert secret_scan.scan(t) == sorted(want)


def test_secrets_of_every_table(spark):
    secret = "the password = 'abcdefghij1' is"
    deflate = zlib.compressobj(wbits=-15)
    bare = deflate.compress(secret.encode() * 3) + deflate.flush()
    for raw in (secret.encode("utf-16"), secret.encode("utf-16-le"), secret.encode("utf-16-be"), bare, zlib.compress(secret.encode("utf-16")), bare + b""):
        assert secret_scan.kinds_in(raw) == {0}, raw
        assert [x[1] for x in secret_scan.findings(base64.b64encode(raw).decode())[1]] == [0]
    assert secret_scan.kinds_in(random.Random(1).randbytes(400)) == set()
    long = "x " * 400_000 + secret
    d = docs_of(spark, [(1, long), (1, long), (2, secret + " " + base64.b64encode(secret.encode()).decode())])
    got = secret_scan.scan_secrets(d).collect()
    assert got[0] == got[1] and got[0].spans == f"assign:{800_004}:{800_004 + 23}" and got[2].spans.count(",") == 1 and secret_scan.scan_secrets(d.limit(0)).count() == 0


def test_secrets_of_repeated_blobs():
    inner = "the password = 'abcdefghij1' is"
    for blob in (base64.b64encode(inner.encode()).decode(), inner.encode().hex(), base64.b64encode(zlib.compress(inner.encode())).decode(), base64.b64encode(base64.b64encode(inner.encode())).decode()):
        n = len(blob)
        added = [x for x in secret_scan.findings(f"{blob} and {blob}, {blob}")[1] if x[1] == 0]
        assert added == [(0, 0, n), (n + 5, 0, 2 * n + 5), (2 * n + 7, 0, 3 * n + 7)]


def test_secrets_of_whole_layers(monkeypatch):
    rng = random.Random(2)
    secret = "the password = 'abcdefghij1' is"
    found = lambda raw: secret_scan.kinds_in(raw)
    # a tar file, whose header is full of NULs, and text that is no UTF-8
    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as f:
        data = (prose(rng, 3000) + secret).encode()
        info = tarfile.TarInfo("notes.txt")
        info.size = len(data)
        f.addfile(info, io.BytesIO(data))
    assert found(tar.getvalue()) == found(b"\xff\xfe\x00 " + secret.encode()) == {0}
    for c in (zlib.compress, gzip.compress, bz2.compress, lzma.compress):
        assert found(c(b"first ") + c(secret.encode())) == {0}, c
        assert found(c(c(b"x") + c(secret.encode())[:-9]) + b"\0" * 4) <= {0}
    # beyond any piece, with windows that cut secrets, characters, gaps and encoded segments
    monkeypatch.setattr(secret_scan, "PIECE", 61)
    monkeypatch.setattr(secret_scan, "WINDOW", 200)
    monkeypatch.setattr(secret_scan, "OVERLAP", 40)
    inner = base64.b64encode(("é" * 300 + secret).encode()).decode()
    for n in range(0, 400, 7):
        for text in (secret, "password" + " " * 900 + "= 'abcdefghij1'", inner, base64.encodebytes(inner.encode()).decode()):
            assert found(zlib.compress(("é " * n + text + " é" * 500).encode())) == {0}, (n, text)


def test_secrets_of_wrapped_base64():
    rng = random.Random(4)
    secret = "the password = 'abcdefghij1' is"
    long = (prose(rng, 100) + secret + prose(rng, 100)).encode()
    for width in (64, 76):
        for end in ("\n", "\r\n", "\n  "):
            for raw in (zlib.compress(long), zlib.compress(zlib.compress(long))):
                b = base64.b64encode(raw).decode()
                text = end.join(b[i : i + width] for i in range(0, len(b), width))
                assert secret_scan.findings(f"see\n{text}\nend")[1] == [(4, 0, 4 + len(text))]
            for shift in range(60):
                b = base64.b64encode(b"-" * shift + secret.encode() + b" -" * 60).decode()
                lines = [b[i : i + width] for i in range(0, len(b), width)]
                found = secret_scan.findings("see " + end.join(lines))[1]
                first, last = (shift + 4) * 4 // 3 // width, (-(-(shift + 27) * 4 // 3) - 1) // width
                step = width + len(end)
                want = (4 + first * step, 0, 4 + last * step + len(lines[last]))
                # a line that could stand alone is found as well
                assert want in found and all(want[0] <= s and e <= want[2] for s, _, e in found)
    # lines that are no wrapped segment: each keeps its own span
    for one in (b"password=abcdefgh1", zlib.compress(b"password=abcdefgh12")):
        b = base64.b64encode(one).decode().rstrip("=")
        n = len(b)
        assert {(i * (n + 1), 0, i * (n + 1) + n) for i in range(3)} <= set(secret_scan.findings("\n".join([b] * 3))[1])


def test_pii(spark):
    rng = random.Random(5)
    parts = ["a@b.co", "x_y@", "@", "c-d.com", "1.2.3.4", "256.1.1.1", ".", "4111 1111 1111 1111", "+1 (499) 555-6503", "+", "12", " ", "_", "-", "abc"]
    rules = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), pii.IP, pii.CARD, pii.PHONE]
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    passes = [lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")), lambda s: 13 <= len(digits(s)) <= 19 and pii.luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15]
    for _ in range(500):
        t = "".join(rng.choice(parts) for _ in range(12))
        assert pii.base_spans(t) == [(k, m.start(), m.end()) for k in range(4) for m in rules[k].finditer(t) if passes[k](m[0])]
        assert [c[:3] for c in pii.candidates(t) if c[3]] == pii.base_spans(t)
    long = "word " * 300_000 + "a@b.com"
    d = docs_of(spark, [(0, None), (1, ""), (2, "mail a@b.com now"), (3, "call (499) 555-6503 phone"), (4, "clean words"), (2, "mail a@b.com now"), (5, long), (6, "1.2.3.4@x.yz")])
    model = pii.fit(d)
    got = [r for r in pii.find_pii(d, model).collect()]
    assert len(got) == 8 and [r.n_email for r in sorted(got, key=lambda r: r.doc_id)] == [0, 0, 1, 1, 0, 0, 1, 1]
    assert {r.doc_id: r.spans for r in got}[6].startswith("email:0:12,ip:0:7") and {r.doc_id: r.spans for r in got}[5] == "email:1500000:1500007"
    m = pii.mask_pii(d, model)
    assert m.columns == d.columns
    text = {r.doc_id: (r.text, r.n_chars) for r in m.collect()}
    assert text[2] == ("mail [EMAIL] now", 16) and text[4][0] == "clean words" and text[0][0] is None and text[6][0] == "[IP]"
    assert pii.find_pii(d.limit(0), pii.fit(d.limit(0))).count() == 0


def personal_corpus(rng, n):
    """(text, kind, start, end): half with one piece of personal data beyond the base kinds, half with something that looks like it."""
    syllables = [f"{a}{b}{e}" for a in "bcdfghlmnprst" for b in "aeiou" for e in ("n", "r", "ted", "ing", "l")]
    prose = lambda: " ".join(rng.choice(syllables) for _ in range(rng.randrange(3, 30)))
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    given, rare, family = ["Maria", "Thomas", "Pierre", "Elena"], ["Ingrid", "Tobias", "Amelie", "Rafael"], ["Miller", "Okafor", "Duval", "Keller", "Novak", "Tanaka"]
    person = lambda first: f"{rng.choice(first)} {rng.choice(family)}"
    day = lambda: f"{rng.randrange(1940, 2005)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d}"

    def iban():
        body = number(18)
        return f"DE{98 - int(''.join(str(int(c, 36)) for c in body + 'DE00')) % 97:02d}{body}"

    true = [
        ("national_id", "my social security number is {}", lambda: f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"), ("iban", "pay to iban {}", iban),
        ("name", "and then {} came along", lambda: person(given)), ("name", "and then {} came along", lambda: person(rare)), ("name", "ask Dr. {} about it", lambda: person(rare)),
        ("email", "contact me at {}", lambda: f"{rng.choice(syllables)} [at] {rng.choice(syllables)} [dot] com"), ("phone", "call me on {}", lambda: f"({number(3)}) {number(3)}-{number(4)}"),
        ("date", "was born {}", day), ("address", "they live at {} now", lambda: f"{rng.randrange(1, 999)} {rng.choice(family)} Street"),
        ("ipv6", "login from host {}", lambda: "2001:db8:" + ":".join(f"{rng.randrange(1, 65535):x}" for _ in range(6))), ("handle", "follow {} there", lambda: "@" + rng.choice(syllables) + number(2)),
    ]
    decoys = [
        ("order number {}", lambda: f"{rng.choice(['000', '666', '900'])}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"), ("part no {}", lambda: "AB12" + number(16)),
        ("version {}", lambda: ".".join(str(rng.randrange(256, 999)) for _ in range(4))), ("published {}", day), ("serial {}", lambda: number(15) + "x"), ("at {} sharp", lambda: "10:20:30"), ("isbn {}", lambda: f"{number(3)}.{number(3)}.{number(4)}"),
    ]
    out = []
    for i in range(n):
        kind, around, make = rng.choice(true) if i % 2 else (None, *rng.choice(decoys))
        before, after = around.split("{}")
        head, span = f"{prose()} {before}", make()
        out.append((f"{head}{span}{after} {prose()}", kind, len(head), len(head) + len(span)))
    return out


def test_pii_beyond_base_kinds(spark):
    """The labelers' aggregation decides: planted data of eleven forms is added, what only looks like it is not."""
    rows = personal_corpus(random.Random(1), 1500)
    d = docs_of(spark, [(i, r[0]) for i, r in enumerate(rows)])
    model = pii.fit(d)
    got = {r.doc_id: r for r in pii.find_pii(d, model).collect()}
    found = [[(k, int(s), int(e)) for k, s, e in (x.split(":") for x in got[i].spans.split(","))] if got[i].spans else [] for i in range(len(rows))]
    planted = [i for i, r in enumerate(rows) if r[1]]
    caught = sum(rows[i][1:] in found[i] for i in planted)
    wrong = sum(not found[i] == [] for i, r in enumerate(rows) if not r[1] and not pii.base_spans(r[0]))
    assert caught >= 0.95 * len(planted) and wrong <= 0.02 * len(planted)
    # a bare name is found by words learned from titles, and the majority of the labelers would have taken many decoys
    assert {"ingrid", "tobias", "amelie", "rafael"} <= model.names
    votes = [pii.unpack(np.array([c[4] for c in pii.candidates(r[0], model.names)])) for r in rows if not r[1]]
    majority = sum(bool(len(v)) and bool(((v == 1).sum(axis=1) > (v == 0).sum(axis=1)).any()) for v in votes)
    assert majority > 10 * max(1, wrong)
    # reliabilities by the plain formula, once more from the posteriors
    loose = [k for k in model.votes.keys if not k[1]]
    assert loose and all(0 <= model.votes.posterior[k] <= 1 for k in loose) and all(model.votes.posterior[k] == 1 for k in model.votes.keys if k[1])


def test_packing(spark, corpus):
    d = docs_of(spark, [*corpus, (9000, "Élan über ﬁn 日本 'S <|endoftext|> don't"), (9001, "x " * 9000)])
    rows = packing.pack(d, max_tokens=512, with_ids=True, group_pieces=64).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    whole = sorted([*t.encode(r.text or "", add_special_tokens=False).ids, 1] for r in d.collect())
    # the ids themselves, document by document, against the tokenizer: words cut by rule and texts handed on whole
    latin = "abcdefgABC éèüßÀª'0123²,.;:!?-_()\t\n\xa0\xad"
    odd = ["".join(random.Random(k).choice(latin) for _ in range(60)) for k in range(300)]
    encode = packing.Encoder(packing.tokenizer_path())
    for text, ids in zip([*odd, *[x or "" for _, x in corpus]], encode([*odd, *[x or "" for _, x in corpus]]), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids
    parts: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        parts.setdefault((r.doc_id, r.piece), []).append(list(r.ids))
    for i, text in [(9000, "Élan über ﬁn 日本 'S <|endoftext|> don't"), (9001, "x " * 9000), *corpus[10:60]]:
        own = [x[0] for (k, _), x in sorted(parts.items()) if k == i]
        assert [y for x in own for y in x] == [*t.encode(text, add_special_tokens=False).ids, 1]
    by: dict = {}
    for r in rows:
        by.setdefault((r.doc_id, r.start), []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids) <= 512 and r.start == 512 * r.piece
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 512
    assert sum(r.length for r in rows) == sum(map(len, whole))
    assert len(packing.sequences(packing.pack(d, max_tokens=512, with_ids=True, group_pieces=64)).collect()) == len(bins)
    lengths = np.random.default_rng(1).integers(1, 200, 500)
    b, o = packing.best_fit(lengths, max_tokens=256, max_docs=3, max_cost=30_000)
    for k in range(b.max() + 1):
        own = lengths[b == k]
        assert own.sum() <= 256 and len(own) <= 3 and ((own**2).sum() <= 30_000 or len(own) == 1)
    assert packing.pack(d.limit(0)).count() == 0


def test_packing_depends_on_the_pieces_alone(spark, corpus):
    d = docs_of(spark, [*corpus, *[(None, "same words") for _ in range(50)], *[(None, None)] * 20])
    shape = lambda x: sorted((r.doc_id or -1, r.piece, r.ids_crc32, r.sequence_id, r.offset) for r in packing.pack(x, max_tokens=512, group_pieces=64).collect())
    one = shape(d)
    assert one == shape(d.repartition(7)) and len({x[3] >> 40 for x in one if x[0] == -1}) > 1


def test_sharding(spark, corpus):
    d = docs_of(spark, corpus * 3)
    rows = sharding.shuffle(d, bucket_bytes=20_000).collect()
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((i, t or "") for i, t in corpus * 3)
    by: dict = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size == len((r.text or "").encode()) + 16 and r.text_crc32 == zlib.crc32((r.text or "").encode())
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(k, [])) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shuffle(d.limit(0)).count() == 0


def test_sharding_is_fixed_by_its_seed(spark, corpus, tmp_path, monkeypatch):
    rows = [*corpus, *corpus[:30], *[(None, "copy")] * 40, (None, None), (None, "other")]
    d = spark.createDataFrame([(None if i is None else f"d{i}", t, 1) for i, t in rows], "doc_id string, text string, size int")
    shape = lambda x, **how: sorted((r.doc_id or "", r.text or "", r.shard, r.slot) for r in sharding.shuffle(x, bucket_bytes=20_000, **how).collect())
    one = shape(d)
    assert one == shape(d.repartition(9)) == shape(d.coalesce(1)) and one != shape(d, seed=1)
    monkeypatch.setattr(sharding, "BLOCK", 2)  # sums over several blocks of buckets
    assert one == shape(d)
    sharding.write(sharding.shuffle(d, shards=5, bucket_bytes=20_000), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id or "", r.text or "") for r in back.collect()) == sorted((x[0], x[1]) for x in one) and {r.shard for r in back.select("shard").distinct().collect()} == set(range(5))
    # plain: positions are one permutation, cut into even parts; neighbours in the input do not stay together
    n = len(rows)
    assert sorted(-(-s * n // 40) + k for _, _, s, k in one) == list(range(n))


def test_media(spark, corpus):
    d = docs_of(spark, corpus)
    got = {r.doc_id: r for r in media.digest_media(media.encode_texts(d)).collect()}
    for i, t in corpus:
        raw = (t or "").encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert got[i].n_bytes == len(raw) and got[i].payload_bytes == len(payload) and got[i].payload_sha256 == hashlib.sha256(payload).hexdigest() and got[i].tail_crc32 == zlib.crc32(payload[-64:])
    def plain_resize(x, w, h):
        """Means over exact areas, cell by cell."""
        weight = lambda n, m: np.array([[max(0.0, min((j + 1) * n / m, i + 1) - max(j * n / m, i)) for i in range(n)] for j in range(m)])
        return weight(x.shape[0], h) @ x @ weight(x.shape[1], w).T / (x.shape[0] / h * x.shape[1] / w)

    for i, t in corpus[:60]:
        raw = (t or "").encode()
        x = np.frombuffer(raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0"), np.uint8).reshape(-1, 64).astype(float)
        cells = np.round(plain_resize(x, 9, 8), 6)
        bits = "".join("1" if cells[r, c + 1] > cells[r, c] else "0" for r in range(8) for c in range(8))
        assert got[i].feature.split(":")[0] == f"{int(bits, 2):016x}"
        small = np.load(io.BytesIO(bytes(got[i].tile)))
        assert small.shape == (32, 32) and np.abs(small - plain_resize(x, 32, 32)).max() <= 0.5 + 1e-6
        assert got[i].feature.split(":")[1] == hashlib.sha256(bytes(got[i].tile)).hexdigest()[:16]
    assert media.digest_media(media.encode_texts(d.limit(0))).count() == 0
    wide = np.random.default_rng(3).integers(0, 256, (37, 11, 3)).astype(np.uint8)
    whole = media.area_resize(wide, 5, 7)
    band, media.BAND = media.BAND, 22
    assert np.allclose(media.area_resize(wide, 5, 7), whole) and np.allclose(whole, plain_resize(media.grey(wide), 5, 7))
    media.BAND = band
    fields = b"BM" + (0).to_bytes(8, "little") + (66).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (16).to_bytes(2, "little") + (3).to_bytes(4, "little") + b"\0" * 20
    fields += b"".join(x.to_bytes(4, "little") for x in (0xF800, 0x07E0, 0x001F)) + (0xF800).to_bytes(2, "little") + (0x07FF).to_bytes(2, "little")
    assert media.decode(fields).tolist() == [[[255, 0, 0], [0, 255, 255]]]
    image = np.arange(24).reshape(4, 6).astype(float)
    assert np.allclose(media.area_resize(image, 3, 2), image.reshape(2, 2, 3, 2).mean(axis=(1, 3)))
    assert np.allclose(media.area_resize(image, 6, 4), image)
    files = {b"P1\n2 2\n1 0 0 1": [[0, 255], [255, 0]], b"P2 # c\n2 1 9\n3 9": [[3, 9]], b"P4\n9 1\n\x80\x80": None, b"P5 2 1 65535\n\x01\x00\x00\x02": [[256, 2]], b"P3 1 1 255 1 2 3": None, b"P6 1 1 255\n\x01\x02\x03": None}
    for data, want in files.items():
        out = media.decode(data)
        if want is not None and data[:2] != b"P1":
            assert out[:, :, 0].tolist() == want
    bmp = b"BM" + (58).to_bytes(4, "little") + b"\0" * 4 + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + b"\0" * 24 + b"\x03\x02\x01\x00"
    assert media.decode(bmp).tolist() == [[[1, 2, 3]]]
    bad = spark.createDataFrame([(1, bytearray(b"nothing")), (2, None), (3, bytearray(bmp))], "media_id long, data binary")
    out = {r.media_id: r for r in media.decode_media(bad).collect()}
    assert out[1].error and out[2].error and out[3].error is None and out[3].width == 1


def test_html(spark):
    page = lambda i, body, extra="": f"<html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav><!-- x --><div class=ad>Buy {i}</div><article><h1>Title {i}</h1>{body}</article>{extra}<footer>f</footer></body></html>"
    rows = [(1, "http://a.example/1", page(1, "<p><b>One &amp; two<br>three<p>four\n five</p>")), (2, "http://a.example/2", page(2, "<p>six</p>", "<div class=comments><p>reader</p></div>")), (3, None, None), (4, "http://b.example/", ""), (5, "http://c.example/x", "<p>plain &lt;b&gt; text"), (6, "http://a.example/3", page(3, "<p>cut").split("</article>")[0])]
    p = spark.createDataFrame([(*r, "h", "w") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_text(p, html_extract.fit_wrappers(p)).collect()}
    assert got[1][0] == "Title 1 One & two three four five" and got[2][0] == "Title 2 six" and got[3] == ("", 0) and got[4] == ("", 0)
    assert got[5][0] == "plain <b> text" and got[6][0] == "Title 3 cut" and got[6][1] == len(got[6][0])
    assert html_extract.extract_text(p.limit(0), html_extract.fit_wrappers(p.limit(0))).count() == 0


def wrapper_of(pages, most=1):
    """The wrapper of a few pages, its figures counted over them."""
    data = html_extract.described(html_extract.infer(pages), len(pages))
    counts = {}
    for p in pages:
        for path, t in html_extract.texts(html_extract.parse(p)):
            c, k = counts.get(path, (0, 0))
            counts[path] = (c + len(t.value), k + t.linked)
    return html_extract.Wrapper(html_extract.judge(data["nodes"], counts) | {"drop": data["fixed"] if len(pages) >= most else []})


def test_html_wrapper_decides():
    """Without a telling name or tag: a menu by its slots full of links, a template's text by its constancy, the body by its prose."""
    words = lambda i: f"page {i} " + "some words of text " * 20
    page = lambda i, a, b, c: f"<html><body><div{a}><div><a href=1>Home</a></div><div><a href=2>About {i}</a></div></div><div{b}><h1>T{i}</h1><p>{words(i)}</p><p><a href=3>a link {i}</a></p></div><div{c}>All rights</div></body></html>"
    for names in (("", "", ""), (" class=a1", " class=search-and-rescue", " class=a3"), (" id=q", " id=menu-page-7", " id=z")):
        pages = [page(i, *names) for i in range(9)]
        w = wrapper_of(pages)
        for i, p in enumerate(pages):
            assert html_extract.extract(p, w) == f"T{i} {words(i).strip()} a link {i}", names
        assert html_extract.extract(pages[0], None) != html_extract.extract(pages[0], w)
    # names of boilerplate around the region or inside it, filled with prose or with links
    body = lambda i: f"<body class='has-sidebar nav-open'><div id=menu-wrapper><header>Site <a>x</a></header><article id=post-{i}><header><h1>Title {i}</h1></header><p>{words(i)}</p><div class=share>Market share {i}.</div><div class=share><a>Tweet {i}</a> <a>Like</a></div><div class=related-work>Other work {i}</div><math><mi>x{i}</mi></math><div class=ad>Buy {i}</div><div id=comments><p>{words(i) * 9}</p></div></article></div></body>"
    pages = [body(i) for i in range(9)]
    for i, p in enumerate(pages):
        for w in (None, wrapper_of(pages)):
            assert html_extract.extract(p, w) == f"Title {i} {words(i).strip()} Market share {i}. Other work {i} x{i}"


def test_html_deep_and_long_pages():
    deep = "<div>" * 50_000 + "text" + "</div>" * 50_000
    assert html_extract.extract(deep, None) == "text"
    html_extract.described(html_extract.infer([deep, deep + "x"]), 2)
    lists = "<ul><li>x" * 30_000
    assert html_extract.extract(lists, None) == " ".join("x" * 30_000)
    long = ["".join(f"<p>a{i}-{k}</p><ul><li>b{k}</li></ul>" for i in range(3_000)) for k in range(3)]  # aligned in order
    assert html_extract.extract(long[1], wrapper_of(long)) == " ".join(f"a{i}-1 b1" for i in range(3_000))
    assert html_extract.extract("<p title='open>cut here", None) == "cut here" and html_extract.extract('<a href="x>y</a><p>z', None) in ("z", "", "y z")


def test_html_siblings_of_one_kind():
    bodies = ["<main><div>short intro</div><div>%s</div></main>", "<body><article>teaser</article><article>%s</article></body>", "<body><div>x</div><div><div>%s</div></div></body>"]
    for body in bodies:
        pages = [body % f"long body {i} {'of many words ' * 9}" for i in range(4)]
        for wrapper in (None, wrapper_of(pages)):
            assert all(f"long body {i} of many" in html_extract.extract(p, wrapper) for i, p in enumerate(pages))


def test_html_keeps_what_is_no_boilerplate():
    lead = "<main><h1>Title</h1><p>lead</p><div class=body>%s</div></main>"
    split = "<div class=w><article>one</article><article>two %s</article><article>three</article><p>after</p></div><nav>no</nav>"
    for i in range(12):
        body = f"body {i} " + "of many words " * 20
        assert html_extract.extract(lead % body, None) == f"Title lead {body.strip()}"
        assert html_extract.extract(split % body, None) == f"one two {body.strip()} three after"
    # a template's constants go, at their own path only
    pages = [f"<main><p>Notice</p><div>text {i}<b>s</b><ul><li>Notice {i}</ul></div></main>" for i in range(9)]
    drop = wrapper_of(pages)
    assert html_extract.extract(pages[3], drop) == "text 3s Notice 3"
    assert html_extract.extract("<main><div>Notice</div></main>", drop) == "Notice"


def test_html_wrappers_from_every_page(spark):
    """Hosts of one template get the same decisions, whichever of their pages a sample would have drawn; the order of rows is no matter."""
    own = lambda i: f"own text {i} {'w' * (i % 7)}"
    page = lambda k, i: f"<div class=all><div class=t>{'Usual' if i % 12 else own(k + i)}</div><p>{own(i)} of {k}</p><p>more {i}</p></div>"
    rows = [(100 * k + i, f"http://h{k}.example/{i}", page(k, i)) for k in range(8) for i in range(60)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_text(p, html_extract.fit_wrappers(p)).collect()}
    assert all(got[100 * k + i] == " ".join(f"{own(k + i) if i % 12 == 0 else ''} {own(i)} of {k} more {i}".split()) for k in range(8) for i in range(60))
    q = p.repartition(7, "html")
    assert got == {r.page_id: r.text for r in html_extract.extract_text(q, html_extract.fit_wrappers(q)).collect()}
    tree = html_extract.collapse(html_extract.parse(rows[1][2]))
    assert html_extract.packed(html_extract.unpacked(html_extract.packed(tree))) == html_extract.packed(tree)


def test_html_templates_by_all_pages(spark, monkeypatch):
    own = lambda i: f"own text {i} {'w' * (i % 7)}"
    rows = [f"<main><div class=n>Notice</div><p>{own(i)}</p><div class=t>{'Usual' if i % 3 else own(i)}</div></main>" for i in range(300)]
    rows += [f"<div class=second><div class=x>Advert</div><p>{own(i)}</p><p>Same</p></div>" for i in range(300, 310)]  # another template, a small share
    rows += [f"<div class=third><div class=y>Few</div><p>{own(i)}</p></div>" for i in range(7)] + ["<main><p>copy</p></main>"] * 40
    p = spark.createDataFrame([(i, "http://h.example/x", h) for i, h in enumerate(rows)], "page_id long, url string, html string")
    for sample in (html_extract.SAMPLE, 3, 0):
        got = {r.page_id: r.text for r in html_extract.extract_text(p, html_extract.fit_wrappers(p, sample=sample)).collect()}
        assert len(got) == len(rows)
        for i in range(300):
            assert got[i] == " ".join(f"{own(i)} {'Usual' if i % 3 else own(i)}".split())
        for i in range(300, 310):
            assert got[i].startswith(own(i).strip()) and "Advert" not in got[i]
        assert all(got[310 + i].startswith("Few own") for i in range(7)) and got[330] == "copy"
        if sample == 3:  # beyond the sizes that are broadcast, the same
            monkeypatch.setattr(html_extract, "BROADCAST_HOSTS", 0)
            monkeypatch.setattr(html_extract, "BROADCAST_BYTES", 0)
            assert got == {r.page_id: r.text for r in html_extract.extract_text(p, html_extract.fit_wrappers(p, sample=sample)).collect()}


def test_pipeline_small(spark, tmp_path):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        seen = stage(spark, seen, d)
        seen.write.parquet(str(tmp_path / name))
        seen = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert seen.columns == docs.columns
    kept = spark.read.parquet(str(tmp_path / "ngram_jaccard_join"))
    components = jaccard_join.join(spark.read.parquet(str(tmp_path / "language_id"))).select("component_id").distinct().count()
    assert kept.count() == components
    assert corpus_pipeline.run(spark, d).count() == seen.count() > 0
