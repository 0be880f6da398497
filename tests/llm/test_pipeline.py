"""The pipeline's rows against a plain version of every stage, written without the operators."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import language_id, packing, pii

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SMALL = str.maketrans(UPPER, LOWER)


def identified(rows, model):
    """Word by word from the model's tables."""

    def of(word):
        if word in model.words:
            return model.word_scores[model.words[word]].astype(float)
        for n in range(5, 0, -1):
            at, scores = model.levels[n]
            padded = f"\x02{word}\x03" if n > 1 else word
            known = [at[padded[i : i + n]] for i in range(len(padded) - n + 1) if padded[i : i + n] in at]
            if known:
                return scores[known].astype(float).mean(axis=0)
        return np.zeros(len(model.langs))

    out = []
    for r in rows:
        words = re.findall(r"[^\W\d_]+", (r["text"] or "").lower())
        if not words:
            continue
        own = np.array([of(w) for w in words])
        best = int(own.sum(axis=0).argmax())
        each = np.exp(own - own.max(axis=1, keepdims=True))
        if (each[:, best] / each.sum(axis=1)).mean() >= 0.4:
            out.append(r | {"lang": r["lang"] if r["lang"] is not None else model.langs[best]})
    return out


def without_copies(rows):
    """All pairs of shingle sets; the least id of each component."""
    words = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"].translate(SMALL)) for r in rows}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [r for r in rows if find(r["doc_id"]) == r["doc_id"]]


def decontaminated(rows, benchmark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = {}
    for b in benchmark:
        w = word.findall((b["text"] or "").translate(SMALL))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(n, set()).add(tuple(w[k : k + n]))
    out = []
    for r in rows:
        w, hit = word.findall(r["text"].translate(SMALL)), set()
        for n, own in grams.items():
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in own:
                    hit |= set(range(k, k + n))
        if not hit or 20 * len(hit) < len(w):
            out.append(r)
    return out


def masked(rows):
    """Base kinds by their rules, match by match; of overlapping ones the union under the first one's kind."""
    rules = {"EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "IP": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "CARD": r"[0-9]([\x20-]?[0-9])+", "PHONE": r"\+[0-9][\x20().0-9-]+[0-9]"}
    digits = lambda s: re.sub(r"[^0-9]", "", s)

    def luhn(s):
        return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0

    keep = {"EMAIL": lambda s: True, "IP": lambda s: all(int(p) <= 255 for p in s.split(".")), "CARD": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), "PHONE": lambda s: 9 <= len(digits(s)) <= 15}
    order = list(rules)
    out = []
    for r in rows:
        found = sorted((m.start(), m.end(), order.index(k), k) for k, p in rules.items() for m in re.finditer(p, r["text"]) if keep[k](m[0]))
        text, last = "", 0
        for s, e, _, k in found:
            if s >= last:
                text += r["text"][last:s] + f"[{k}]"
            last = max(last, e)
        out.append(r | {"text": text + r["text"][last:]})
    return out


def test_rows_of_every_stage(spark):
    from tokenizers import Tokenizer

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    model = language_id.fit(docs.filter(~language_id.held_out("doc_id")))
    kept = identified(rows, model)
    assert {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, d).collect()} == {r["doc_id"]: r["lang"] for r in kept}
    kept = decontaminated(without_copies(kept), [r.asDict() for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()])
    assert 0 < len(kept) < len(rows)
    # the tables hold personal data of the base kinds alone, so the model adds nothing here
    assert all(not pii.Model().spans(r["text"])[1] for r in kept)
    want = {}
    t = Tokenizer.from_file(packing.tokenizer_path())
    for r in masked(kept):
        ids = np.array([*t.encode(r["text"], add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[r["doc_id"], k // 4096] = (k, len(part), zlib.crc32(part.tobytes()))
    got = corpus_pipeline.run(spark, d).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x + n == y for (x, n), (y, _) in zip(b, b[1:], strict=False)) and sum(b[-1]) <= 4096
    total = sum(n for _, n, _ in want.values())
    assert len(bins) <= 1.15 * -(-total // 4096) + 1


def test_stages_of_an_empty_table(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0).withColumn("id", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, d).count() == 0


def test_stages_give_back_heap(spark, tmp_path):
    """Each stage begins with a full collection of the executors' heaps (here the driver's, which is the executor)."""
    spark.createDataFrame([("b", "one two")], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, "so it is", "en", "s", 8)], "doc_id long, text string, lang string, source string, n_chars long")
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    for name, stage in corpus_pipeline.STAGES:
        before = full()
        stage(spark, docs, str(tmp_path))
        assert full() > before, name
