"""The pipeline stage by stage against plain Python, and its registration."""

import random
import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "substring_dedup", "decontamination", "bpe_encoding"]


def test_run_against_brute_force(spark, make_docs, tmp_path):
    rnd = random.Random(8)

    def words(n):
        return [f"w{rnd.randrange(9000)}" for _ in range(n)]

    fine = [(k, " ".join(words(90))) for k in range(260)]
    short = [(1000, "too short"), (1001, None), (1002, "")]
    base = words(100)
    near = [(1100 + k, " ".join(base[:k * 7] + ["changed"] + base[k * 7 + 1:])) for k in range(6)]
    passage = " ".join(words(59)) + " end."
    repeated = [(1200 + k, " ".join(words(70)) + ".\n" + passage) for k in range(4)]
    item = " ".join(words(25))
    leak = [(1300, " ".join(words(60)) + " " + item + " " + " ".join(words(60)))]
    rows = fine + short + near + repeated + leak
    make_docs(rows).drop("n_words").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = {i: t for i, t in rows if i < 1000 or i == 1100 or 1200 <= i < 1300}
    for k in range(1, 4):
        want[1200 + k] = want[1200 + k].split("\n")[0] + "\n"
    assert {i: r.text for i, r in out.items()} == want
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in out.items():
        assert list(r.ids) == library.encode(want[i], add_special_tokens=False).ids
        assert r.decoded_sha256 == brute.sha(want[i].encode()) and r.n_chars == len(want[i])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    empty = docs.filter("doc_id > 99999")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_queries_are_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    df = names["op4_quality_rules"](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert df.filter(F.col("base_failed") & F.col("kept")).count() == 0
