"""Fingerprints, PII, quality and mixing against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gapscan.llm import fingerprints, mixing, pii, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    ws = WORD.findall(text or "")
    if not ws:
        return set()
    return {tuple(ws[i:i + width]) for i in range(max(len(ws) - width, 0) + 1)}


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def ordered(docs):
    return sorted(docs, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_fingerprints(spark, edge_docs, sf_docs, write_docs, which):
    docs = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"]) if which == "edge" else sf_docs
    rows = ordered(docs.collect())
    got = {r["doc_id"]: r for r in fingerprints.op1_fingerprints(spark, write_docs(docs)).collect()}
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    for i, r in enumerate(rows):
        t, nxt = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(t)
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert g["near_edited"] == pytest.approx(jaccard(shingles(t), shingles(edited)), abs=0.15)
        assert g["near_next"] == pytest.approx(jaccard(shingles(t), shingles(nxt)), abs=0.15)
        assert g["n_shingles"] == pytest.approx(len(shingles(t)), rel=0.3)
        by_text[t].add(g["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_fingerprints_whole_table(spark, edge_docs, write_docs):
    d = write_docs(edge_docs)
    assert fingerprints.op1_fingerprints(spark, d).count() == edge_docs.count()
    d = write_docs(edge_docs.limit(0))
    assert fingerprints.op1_fingerprints(spark, d).count() == 0
    d = write_docs(edge_docs.where("doc_id = 4"))
    assert fingerprints.op1_fingerprints(spark, d).first()["near_next"] == 1.0


def test_merge_and_containment(spark, sf_docs):
    from pyspark.sql import functions as F
    df = sf_docs.withColumn("s", fingerprints.fingerprint(F.col("text"), k=64))
    got = {r["lang"]: r["s"] for r in fingerprints.merge_sketches(df, ["lang"], "s", 64).collect()}
    for lang, s in got.items():
        hashes = sorted({h for r in df.where(F.col("lang") == lang).select(
            F.explode(fingerprints.shingle_hashes(F.col("text"))).alias("h")).collect() for h in [r["h"]]})
        assert s == hashes[:64]
    half = spark.createDataFrame([("a b c d e f g h i j", "a b c d e f g", )], "x string, y string").select(
        fingerprints.containment(fingerprints.fingerprint(F.col("y")), fingerprints.fingerprint(F.col("x"))).alias("c"))
    assert half.first()["c"] == 1.0


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+",
         lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]


def base_spans(text):
    out = []
    for rank, (kind, p, ok) in enumerate(BASE):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(p, text or "") if ok(m.group())]
    return sorted(out)


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_pii(spark, edge_docs, sf_docs, write_docs, which):
    docs = edge_docs if which == "edge" else sf_docs
    rows = pii.op2_pii(spark, write_docs(docs)).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        want = base_spans(text[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (r["doc_id"], joined, r["spans"])
        for k, _, _ in BASE:
            assert r[f"n_{k}"] == sum(x[2] == k for x in want)
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    if which == "edge":
        by = {r["doc_id"]: r["spans"] for r in rows}
        assert by[12].count("iban") == 2
        assert "ssn" in by[13]


def test_pii_very_long_runs(spark, write_docs):
    """Runs that a backtracking engine would need a deep stack for."""
    texts = ["1" * 100_000, "4 " * 50_000, "+1" * 20_000, "1." * 2_000, "a@" * 20_000, "a@b" + ".c" * 30_000,
             "4111 1111 1111 1111, " * 50 + "9" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.op2_pii(spark, write_docs(df)).collect():
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in base_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_pii_scores_from_the_neighbourhood(spark):
    """Scores by context words within reach, however many spans stand between."""
    import random
    rnd = random.Random(8)
    parts = ["1.2.3.4", "10.0.0.255", "300.1.1.1", "a@b.c", "x.y@host.example", "+1 555 123 4567", "+1234567890", " ", " ",
             ", ", "host", " server ", "call", "mail to ", " e-mail", "lorem ipsum dolor sit amet ", "é" * 47, "ip",
             "4111 1111 1111 1111", "4111111111111112", "card", "\n", "DE89370400440532013000", "123-45-6789", "SSN"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        text = r["text"] or ""
        for kind in pii.KINDS:
            got = [(s["start"], s["end"], round(s["score"], 2)) for s in r["pii"] if s["kind"] == kind.name]
            for start, end, score in got:
                near = text[max(start - 48, 0):start], text[end:end + 48]
                more = any(re.search(kind.context, x) for x in near)
                assert score == round(kind.score + 0.3 * more, 2), (kind.name, start, text)


def test_pii_time_follows_the_spans(spark):
    """Ten times the spans of a text take about ten times as long."""
    import time
    took = {}
    for n in (1000, 10_000, 100_000):
        df = spark.createDataFrame([(0, "10.1.2.3 at a@b.cd, " * (n // 2))], "doc_id long, text string")
        t = time.perf_counter()
        row = pii.find_pii(df).select(F.size("pii"), F.element_at("pii", -1)).first()
        took[n] = time.perf_counter() - t
        assert row[0] == n and row[1]["end"] == 10 * n - 2
    assert took[100_000] < 30 * max(took[10_000], 0.5)


def stats(text):
    ws = WORD.findall(text or "")
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    c = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return dict(n_words=len(ws), word_chars=sum(map(len, ws)), n_symbols=len(re.findall(r"[#*$%&|<>]", text or "")),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(hit), n_lines=len(lines))


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_quality(spark, edge_docs, sf_docs, write_docs, which):
    docs = edge_docs if which == "edge" else sf_docs
    rows = quality.op3_quality(spark, write_docs(docs)).collect()
    src = docs.collect()
    assert len(rows) == len(src)
    want = {r["doc_id"]: stats(r["text"]) for r in src}
    measures = defaultdict(list)
    per = {}
    for r in src:
        s = want[r["doc_id"]]
        bad = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        m = {k: min(v[2] * s[v[0]] // s[v[1]] if s[v[1]] else 0, quality.TOP) for k, v in quality.MEASURES.items()}
        per[r["doc_id"]] = (bad, r["lang"], r["source"], m)
        if not bad:
            measures[r["lang"], r["source"]].append(m)

    def fence(group, k):
        vals = sorted(m[k] for m in measures[group])
        q1, q3 = (vals[math.ceil(q * len(vals) / 4) - 1] for q in (1, 3))
        return q3 + quality.SPREAD * max(q3 - q1, quality.MEASURES[k][3])
    for r in rows:
        s = want[r["doc_id"]]
        for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            assert r[k] == s[k], (r["doc_id"], k)
        bad, lang, source, m = per[r["doc_id"]]
        assert r["base_failed"] == bad
        assert r["kept"] == (not bad and all(m[k] <= fence((lang, source), k) for k in m))


def water_fill(sizes, share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    t, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * unit >= cap * sizes[s]}
        if not full:
            t.update({s: w[s] * unit for s in open_})
            break
        for s in full:
            t[s] = cap * sizes[s]
            left -= t[s]
        open_ -= full
    return t


def test_repeated_words_by_the_whole_hash(spark):
    """Two windows whose hashes share their lower 47 bits, all that a text of
    70,000 words once compared, are no repeat; one true repeat is."""
    filler = [f"u{k}" for k in range(70_000)]
    ws = ["left left 1f212f7", *filler[:100], "left left f5cd2d", *filler[100:], "r1 r2 r3 between r1 r2 r3"]
    df = spark.createDataFrame([(" ".join(ws),)], "text string")
    lower = [r[0] & (1 << 47) - 1 for r in spark.sql(
        "select xxhash64('left', 'left', x) from values ('1f212f7'), ('f5cd2d') t(x)").collect()]
    assert lower[0] == lower[1]
    assert quality.text_stats(df).first()["n_repeat_words"] == 6


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_mix(spark, edge_docs, sf_docs, write_docs, which, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", 7)
    docs = edge_docs if which == "edge" else sf_docs
    d = write_docs(docs)
    rows = mixing.op5_mix(spark, d).collect()
    src = docs.collect()
    assert len(rows) == len(src)
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in src}
    source = {r["doc_id"]: r["source"] for r in src}
    sizes = defaultdict(int)
    for r in src:
        sizes[r["source"]] += size[r["doc_id"]]
    want = water_fill(sizes)
    took = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        took[s] += r["taken"]
    for s in sizes:
        assert abs(took[s] - want[s]) <= 1
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.op5_mix(spark, d).collect()), key=str)
    whole = mixing.mix(docs)
    assert whole.columns == docs.columns
    copies = defaultdict(int)
    for r in whole.collect():
        copies[r["source"]] += len(WORD.findall(r["text"]))
    assert dict(copies) == {s: n for s, n in took.items() if n}


def test_mix_empty(spark, edge_docs, write_docs):
    assert mixing.op5_mix(spark, write_docs(edge_docs.limit(0))).count() == 0
    assert mixing.mix(edge_docs.limit(0)).count() == 0
    assert quality.op3_quality(spark, write_docs(edge_docs.limit(0))).count() == 0
    assert pii.op2_pii(spark, write_docs(edge_docs.limit(0))).count() == 0
