"""The pipeline: every stage on what the one before kept, held against plain Python, and the registration."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import xxhash
from pyspark.sql import functions as F

from gapscan.llm import toxicity
from gapscan.llm.tokens import default_tokenizer
from gapscan.staging import staged_paths

D = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
GAP = " \t\n\x0b\f\r"
STAGE = dict(corpus_pipeline.STAGES)


def without_common_lines(rows, min_words=30):
    """{(doc_id, text): text left}: lines of windows that an earlier document holds go."""
    def windows(lines):
        for step in (1, -1):
            for i in range(len(lines)):
                n, j = 0, i
                while n < min_words and 0 <= j < len(lines):
                    n, j = n + len(WORD.findall(lines[j][1])), j + step
                if n >= min_words:
                    own = sorted(lines[x] for x in range(i, j, step))
                    yield tuple(x for _, x in own), {at for at, _ in own}
    held = defaultdict(list)
    for doc_id, text in {r for r in rows if r[0] is not None and r[1] is not None}:
        lines = [(at, x.strip(GAP)) for at, x in enumerate(text.split("\n")) if x.strip(GAP)]
        for w, ats in windows(lines):
            held[w].append((doc_id, text, ats))
    out = {r: r[1] for r in rows}
    gone = defaultdict(set)
    for holders in held.values():
        first = min(d for d, _, _ in holders)
        for doc_id, text, ats in holders:
            if doc_id != first:
                gone[doc_id, text] |= ats
    for (doc_id, text), ats in gone.items():
        out[doc_id, text] = "\n".join(x for at, x in enumerate(text.split("\n")) if at not in ats)
    return out


def simhash(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def near_groups(texts):
    """Group number of each text, by links of at most three bits."""
    bits = [simhash(t) for t in texts]
    distinct = sorted(set(bits))
    group = {b: b for b in distinct}
    todo = set(distinct)
    while todo:
        reached = [todo.pop()]
        root = reached[0]
        while reached:
            x = reached.pop()
            group[x] = root
            near = {y for y in todo if (x ^ y).bit_count() <= 3}
            todo -= near
            reached += near
    return [group[b] for b in bits]


def share_words(sizes):
    """Targets of the sources by water filling, found by halving the level."""
    ranked = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(ranked)}
    total, low, high = 1.5 * sum(sizes.values()), 0.0, 4.0 * sum(sizes.values()) + 1
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(2 * sizes[s], weight[s] * middle) for s in sizes) < total:
            low = middle
        else:
            high = middle
    return {s: min(2 * sizes[s], weight[s] * high) for s in sizes}


def n_words(text):
    return len(WORD.findall(text or ""))


def check_stage(spark, name, docs, out):
    """The rows of a stage's result against plain Python over its input."""
    before, after = docs.collect(), out.collect()
    if name != "packing":
        assert out.columns == docs.columns
    if name == "line_dedup":
        if len({r["doc_id"] for r in before}) == len({(r["doc_id"], r["text"]) for r in before}):
            want = without_common_lines([(r["doc_id"], r["text"]) for r in before])
            assert Counter((r["doc_id"], r["text"]) for r in after) == Counter(
                (r["doc_id"], want[r["doc_id"], r["text"]]) for r in before)
        else:
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after)
    if name == "simhash":
        groups = near_groups([r["text"] for r in before])
        least = {}
        for g, r in zip(groups, before):
            rank = (r["doc_id"] is None, r["doc_id"] or 0)
            least[g] = min(least.get(g, rank), rank)
        assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == Counter(least.values())
        assert len(after) == len(set(groups))
    if name == "mixing":
        sizes, took = defaultdict(int), defaultdict(int)
        for r in before:
            sizes[r["source"]] += n_words(r["text"])
        for r in after:
            took[r["source"]] += n_words(r["text"])
        target = share_words(sizes)
        assert all(abs(took[s] - target[s]) <= 1 for s in sizes) and set(took) <= set(sizes)
        copies = Counter(r["doc_id"] for r in after)
        assert all(n <= 2 * Counter(r["doc_id"] for r in before)[d] for d, n in copies.items())
    if name == "packing":
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(default_tokenizer())
        want, bins = Counter(), defaultdict(list)
        for r in before:
            ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [0]
            cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
            for p, (a, z) in enumerate(zip(cuts, cuts[1:])):
                want[r["doc_id"], p, a, z - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:z]))] += 1
        assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in after)
        for r in after:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for b in bins.values():
            at = 0
            for offset, n in sorted(b):
                assert offset == at
                at += n
            assert at <= 2048


def chain(spark, docs, sf_dir, tmp_path):
    """Every stage on what the one before kept; the results by name."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/out/{name}")
        out[name] = spark.read.parquet(f"{tmp_path}/out/{name}")
        check_stage(spark, name, docs, out[name])
        docs = out[name]
    assert len(corpus_pipeline.STAGES) == 5
    return out


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{D}/labels.parquet").where("toxic = 1").collect()}
    kept = {r["doc_id"] for r in chain(spark, docs, D, tmp_path)["toxicity"].collect()}
    assert len(toxic - kept) > 0.7 * len(toxic)
    clean = {r["doc_id"] for r in spark.read.parquet(f"{D}/labels.parquet").where("toxic = 0").collect()}
    assert len(clean & kept) > 0.95 * len(clean)


def test_edge_table_through_all_stages(spark, edge_docs, write_docs, tmp_path):
    """Nulls, empty, very long and repeated texts, ties, and columns whose names
    clash with the operators' own."""
    clash = {c: F.lit("x") for c in ("doc", "at", "k", "uid", "fp", "deleted", "position", "length", "seg_id", "words", "toxic")}
    docs = edge_docs.withColumns(clash)
    d = write_docs(docs)
    labels = [(4, 1, 0), (5, 0, 1), (6, 0, 1), (7, 1, 0), (8, 1, 0), (9, 1, 0), (10, 0, 1), (11, 1, 0)]
    write_docs(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labels")
    out = chain(spark, spark.read.parquet(f"{d}/documents.parquet"), d, tmp_path)
    # the first stage keeps what the same model scores below the threshold
    scored = toxicity.op7_toxicity(spark, d).where("predicted = 0").select("doc_id").collect()
    assert Counter(r["doc_id"] for r in out["toxicity"].collect()) == Counter(r["doc_id"] for r in scored)
    # the stages after the classifier, on the whole edge table
    for name in ("line_dedup", "simhash", "mixing", "packing"):
        got = STAGE[name](spark, docs, d)
        got.write.parquet(f"{tmp_path}/alone/{name}")
        check_stage(spark, name, docs, spark.read.parquet(f"{tmp_path}/alone/{name}"))


def test_empty_table_through_all_stages(spark, edge_docs, write_docs, tmp_path):
    d = write_docs(edge_docs.limit(0))
    write_docs(spark.createDataFrame([], "doc_id long, quality int, toxic int"), "labels")
    out = chain(spark, edge_docs.limit(0), d, tmp_path)
    assert all(frame.count() == 0 for frame in out.values())


def test_run_leaves_only_its_last_stage(spark, write_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = set(staged_paths(spark))
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and docs.count() > 0
    # the documents of the last stage, and what packing itself staged
    left = [p.rsplit("/", 1)[1].split("-")[2] for p in staged_paths(spark) if p not in before]
    assert set(left) == {"mixing", "pieces", "round"} and left.count("mixing") == 1


@pytest.mark.parametrize("source", ["a", None])
def test_equal_documents_in_two_sources(spark, source):
    """Rows equal in doc_id and text, in two sources, each count for their own."""
    rows = [(1, "one two three four", "a"), (1, "one two three four", source or "b"), (2, "five six " * 30, "b"),
            (3, "seven " * 9, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    check_stage(spark, "mixing", docs, STAGE["mixing"](spark, docs, ""))


def test_registered():
    import __spark_entry__ as e
    names = set(e.queries())
    assert {n.split("_")[0] for n in names if re.fullmatch(r"op\d+_.*", n)} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
