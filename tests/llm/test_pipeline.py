import hashlib
import re

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken

from chorale.llm import byte_bpe, queries

from test_jaccard_join import brute as components_of
from test_sharding_mixing import targets
from test_substring_dedup import brute as cut_of


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(("documents", docs))
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
        out.append((name, docs))
    return {name: (df.columns, [r.asDict() for r in df.collect()]) for name, df in out}


def test_stages_keep_the_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "substring_dedup", "mixing", "byte_bpe"]
    for name in names[:-1]:
        assert stages[name][0] == stages["documents"][0]


def test_toxic_documents_go_and_clean_ones_stay(stages, sf_dir):
    kept = {r["doc_id"] for r in stages["toxicity"][1]}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall()
    clean = [i for i, t in labels if t == 0]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert kept < {r["doc_id"] for r in stages["documents"][1]}


def test_one_of_each_group_stays(stages):
    before, after = stages["toxicity"][1], stages["jaccard_join"][1]
    groups = components_of([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {i for i, _, c in groups if i == c}


def test_repeats_are_cut(stages):
    before, after = stages["jaccard_join"][1], stages["substring_dedup"][1]
    texts = {r["doc_id"]: r["text"] for r in after}
    for i, _, gone, left in cut_of([(r["doc_id"], r["text"]) for r in before], 35):
        assert texts[i] == (left if gone else next(r["text"] for r in before if r["doc_id"] == i))


def test_sources_reach_their_targets(stages):
    before, after = stages["substring_dedup"][1], stages["mixing"][1]
    size = lambda rows: {s: sum(len((r["text"] or "").split()) for r in rows if r["source"] == s) for s in {r["source"] for r in before}}
    sizes, taken = size(before), size(after)
    wanted = targets(sizes)
    for s, most in sizes.items():
        longest = max(len((r["text"] or "").split()) for r in before if r["source"] == s)
        assert abs(taken[s] - wanted[s]) <= longest / 2 + 1 and taken[s] <= 3 * most


def test_tokens_are_the_library_s(stages):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.vocabulary(byte_bpe.RANKS), special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stages["mixing"][1]}
    assert len(stages["byte_bpe"][1]) == len(stages["mixing"][1])
    for r in stages["byte_bpe"][1]:
        assert r["tokens"] == library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(r["tokens"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    found = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect())
    assert found == sorted((r["doc_id"], r["n_tokens"]) for r in stages["byte_bpe"][1])


def test_stages_on_odd_rows(spark, documents, odd_rows, tmp_path):
    place = str(tmp_path)
    labels = [(k, 1, int(k == 9)) for k in range(1, 10)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    docs = documents(odd_rows + [(9, "toxic words"), (None, None)], extra=("n", "k")).withColumnsRenamed({"x0": "node", "x1": "copies"})
    # The seventh is one passage over and over: nothing of it is left to mix.
    wanted = {"toxicity": {1, 2, 3, 7, None}, "jaccard_join": {1, 2, 3, 7, None}, "substring_dedup": {1, 2, 3, 7, None}}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, place)
        if name != "byte_bpe":
            assert docs.columns == columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {*range(1, 10), None} and ids >= {4, 6} | wanted.get(name, set())
        empty = stage(spark, documents([]), place)
        assert empty.count() == 0
    assert docs.where("doc_id = 1").count() == 0 and docs.where("doc_id = 4").count() >= 1


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES if re.match(r"op[0-9]", name)]
    assert numbers == list(range(1, 14))
