from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cloudweft.llm import bpe, common, exact, language, license_scan, quality, token_count
from tests.llm.corpus import corpus


def test_written_tables_and_discards(spark):
    mark = common.tables()
    a, b = common.written(spark.range(3), "a"), common.written(spark.range(4), "b")
    assert a.count() == 3
    common.discard(spark, mark, b)
    assert b.count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(a._cloudweft_path).count()


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/"
    assert common.shared_dir(Session()) == "hdfs://x"


def test_two_threads_keep_their_own_tables(spark, table):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")}
    frames = [table(corpus(k, 20)) for k in range(2)]
    want = [exact.drop_copies(df).count() for df in frames]

    def run(k):
        mark = common.tables()
        kept = common.written(frames[k], "own")
        for _ in range(3):
            common.discard(spark, mark, kept)
            found = exact.drop_copies(kept).count()
        return found

    with ThreadPoolExecutor(2) as both:
        assert list(both.map(run, range(2))) == want
    assert {k: spark.conf.get(k, None) for k in before} == before


@pytest.mark.parametrize(
    ("call", "own"),
    [
        (lambda df: quality.signal_table(df), ["N_Words", "Pattern"]), (lambda df: language.predict(df, language.fit(df)), ["Lang_Pred", "Score"]),
        (lambda df: bpe.encode_table(df), ["N_Tokens", "IDS"]), (lambda df: license_scan.scan(df), ["Matches", "x"]), (lambda df: token_count.count_tokens(df), ["N_Tokens", "Over_Limit"]),
    ],
    ids=["quality", "language", "bpe", "license", "tokens"],
)
def test_clashing_and_odd_columns(spark, table, call, own):
    """Columns that differ from the result's in case only are replaced; odd names and structs stay."""
    plain = table([(1, "some words and more", "en"), (2, None, "en"), (3, "", None)])
    df = plain.withColumnsRenamed({"source": own[0], "n_chars": own[1]}).withColumn("a`b", F.lit(1)).withColumn("s", F.struct(F.lit(1).alias("a-b"), F.lit("x").alias("c d")))
    out = call(df)
    low = [c.lower() for c in out.columns]
    assert len(low) == len(set(low)) and {"doc_id", "a`b", "s"} <= set(out.columns) and own[0] not in out.columns
    rows = out.collect()
    assert len(rows) == 3 and all(r["a`b"] == 1 and r.s["a-b"] == 1 for r in rows)


def test_long_values_are_taken_by_themselves():
    import pyarrow as pa

    from cloudweft.llm.common import in_pieces

    batch = pa.record_batch({"a": ["x" * (3 << 20), "y" * (3 << 20), "z"]})
    parts = list(in_pieces([batch, batch.slice(2)]))
    assert [p.num_rows for p in parts] == [1, 2, 1]
    assert pa.Table.from_batches(parts).column(0).to_pylist() == [*batch.column(0).to_pylist(), "z"]


def test_long_rows_are_not_copied_again(spark, table):
    from cloudweft.llm import bpe, mixing

    docs = table([(k, f"word{k} common words " * 10) for k in range(40)] + [(40, "Some words\nand others " * 9000)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    encoded = bpe.encode_table(docs)
    assert "Project" not in plan(encoded).split("MapInArrow")[0]
    found = {r.doc_id: r for r in encoded.collect()}
    codec = bpe.encoding(bpe.public_tokenizers.path(bpe.RANK_FILE), bpe.public_tokenizers.PATTERN)
    for r in docs.collect():
        assert found[r.doc_id].ids == codec.encode_ordinary(r.text) and bytes(found[r.doc_id].decoded).decode() == r.text
    marks = spark.createDataFrame([(k, int(k % 4 > 0), int(k % 5 == 0)) for k in range(30)], "doc_id long, quality int, toxic int")
    named = docs.withColumnsRenamed({"lang": "copy", "source": "side_id"})
    out = mixing.mix(named, marks)
    assert "named_struct(" not in plan(out) and " AS doc#" not in plan(out) and out.columns == named.columns
    want = {r.id: r.copies for r in mixing.mixed(named.select("doc_id", "text"), marks).collect()}
    got = [r.doc_id for r in out.collect()]
    assert {k: got.count(k) for k in want} == want
