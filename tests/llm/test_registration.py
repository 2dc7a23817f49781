"""What the entry point registers, and the pipeline as a whole."""

import os
import subprocess
import sys

import __spark_entry__ as entry
import corpus_pipeline
import public_tokenizers
from llm_helpers import SF, given

from check import compare, connect
from millrace.llm import byte_bpe
from millrace.llm.queries import ORACLES, QUERIES, RANKS


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()


def test_sql_counterparts(spark):
    con = connect(SF)
    for name, text in ORACLES.items():
        assert compare(spark, con, SF, name, entry.queries()[name], text) == "ok"


def test_pipeline_keeps_columns_and_encodes_what_it_kept(spark, tmp_path):
    docs = given(spark, "documents")
    first = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == first.columns, name
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) > 0
        assert set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    library = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    rows = docs.collect()
    assert len(rows) == len(texts)
    assert all(r.ids == library.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in rows)


def test_a_session_without_a_shared_folder():
    """The operators name a folder of their own where ``spark.checkpoint.dir`` is unset."""
    code = (
        "import sys; from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.warehouse.dir', sys.argv[1]).config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from millrace.llm.components import components\n"
        "print(components(spark.createDataFrame([(1, 2)], 'a long, b long')).count())\n"
    )
    import tempfile

    with tempfile.TemporaryDirectory() as folder:
        root = os.path.dirname(os.path.abspath(entry.__file__))
        done = subprocess.run([sys.executable, "-c", code, folder], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["2"], done.stderr[-2000:]
