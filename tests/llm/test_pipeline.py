"""The pipeline's stages, each against brute force on what the one before it kept."""

import hashlib
import re
from collections import Counter

import pytest

cp = pytest.importorskip("corpus_pipeline")
from quotewell.llm import jaccard, mixing, quality, simhash  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """name -> rows of the stage's result."""
    docs, home, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), tmp_path_factory.mktemp("stages"), {}
    out["documents"] = docs.collect()
    for name, f in cp.STAGES:
        made = f(spark, docs, sf_dir)
        if name != cp.STAGES[-1][0]:
            assert made.columns == docs.columns
        made.write.parquet(str(home / name))
        docs = spark.read.parquet(str(home / name))
        out[name] = docs.collect()
    return out


def test_order():
    assert [n for n, _ in cp.STAGES] == ["quality", "exact", "near", "mix", "tokens"] and cp.ORACLE_SQL is None


def test_quality_keeps_what_the_rules_keep(spark, sf_dir, stages):
    told = quality.quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).where("kept").collect()
    assert {r.doc_id for r in stages["quality"]} == {r.doc_id for r in told} and 0 < len(told) < len(stages["documents"])


def test_exact_keeps_the_largest_of_equals(stages):
    best = {}
    for r in stages["quality"]:
        best[r.text] = max(r.doc_id, best.get(r.text, -1))
    assert Counter((r.doc_id, r.text) for r in stages["exact"]) == Counter((i, t) for t, i in best.items())


def test_near_keeps_one_of_each_group(stages):
    rows = stages["exact"]
    prints = [simhash.fingerprint_pair(r.text.encode(), cp.NEAR_SHINGLE, True) for r in rows]
    sets = [set(jaccard.shingle_set(r.text.encode(), cp.NEAR_SHINGLE).tolist()) for r in rows]
    similar = lambda a, b: bool(a) and bool(b) and len(a & b) >= cp.NEAR_LEAST * len(a | b)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            near = (prints[i][0] ^ prints[k][0]).bit_count() <= cp.NEAR_BITS and (prints[i][1] ^ prints[k][1]).bit_count() <= cp.NEAR_SECOND_BITS
            if near or similar(sets[i], sets[k]):
                root[find(i)] = find(k)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(r.doc_id, least.get(find(i), r.doc_id))
    assert {r.doc_id for r in stages["near"]} == set(least.values())


def test_mix_repeats_rows_as_planned(spark, sf_dir, stages):
    kept = spark.createDataFrame(stages["near"])
    plan = {r.id: r.copies for r in mixing.mix(kept, **mixing.production()).collect()}
    assert Counter(r.doc_id for r in stages["mix"]) == Counter({i: n for i, n in plan.items() if n})


def test_tokens_are_those_of_the_library(stages):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from quotewell.llm.bpe import read_ranks

    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=read_ranks(public.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(r.text.encode())) for r in stages["mix"] for ids in [library.encode_ordinary(r.text)])
    assert Counter(tuple(r) for r in stages["tokens"]) == want


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows, ids with several texts, clashing columns; and no rows at all."""
    good = lambda k: " ".join(f"w{(k * 31 + j * j) % 997}" for j in range(80))
    rows = [(k, good(k), "en", f"src{k % 6}", 1, True) for k in range(40)]
    rows += [(None, good(50), None, None, 2, None), (None, None, "en", "src1", 3, None), (60, "", "de", "src2", 4, True), (61, " ".join(f"v{j}" for j in range(30_000)), "fr", "src3", 5, False)]
    rows += [rows[0], rows[0], (1, good(70), "en", "src1", 6, True), (80, good(3) + " more", "en", "src3", 7, True)]
    schema = "doc_id bigint, text string, lang string, source string, n bigint, kept boolean"
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema).repartition(3)
        sizes = []
        for name, f in cp.STAGES:
            out = f(spark, docs, str(tmp_path))
            path = str(tmp_path / f"{name}-{len(some)}")
            out.write.parquet(path)
            assert name == "tokens" or out.columns == docs.columns
            docs = spark.read.schema(out.schema).parquet(path)
            sizes.append(docs.count())
        # without labels the base rules decide: texts of fewer than 50 words go; equal texts; one near copy
        assert sizes[:3] == ([46, 44, 43] if some else [0, 0, 0]) and (sizes[3] > 0) == bool(some)


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    assert Counter(tuple(r) for r in cp.run(spark, sf_dir).collect()) == Counter(tuple(r) for r in stages["tokens"])
