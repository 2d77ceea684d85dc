"""Execution-model guarantees of the package."""
import re
from pathlib import Path
from urllib.parse import urlparse

from sessionkit.session import ensure_checkpoint_dir, materialize, scratch_path

PKG = Path(__file__).resolve().parents[1] / "sessionkit"


def test_lineage_cuts_go_to_the_shared_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/")
    df = materialize(spark.range(10), "hygiene")
    files = df.inputFiles()
    base_path = urlparse(base).path.rstrip("/")
    assert files and all(urlparse(f).path.startswith(base_path + "/") for f in files)
    assert df.count() == 10


def test_no_local_checkpoint_and_no_python_udfs():
    src = {p: p.read_text() for p in PKG.rglob("*.py")}
    assert not any(".localCheckpoint(" in x for x in src.values())
    assert not any(re.search(r"\bF\.udf\b|@udf|pandas_udf", x) for x in src.values())
    # blocks of arrays that live from round to round: the one use of RDDs
    assert [p.name for p, x in src.items()
            if re.search(r"\.rdd\.map|mapPartitions\(", x)] == ["boosting.py"]
