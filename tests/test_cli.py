"""The monthly refresh from the command line writes the seven dashboards."""

from pathwise.__main__ import main
from pathwise.sources.publish import new_run_dir, shared_dir
from pathwise.sources.schemas import DASHBOARD_SCHEMAS, struct
from pathwise.sources.snapshots import SnapshotTable

from conftest import SF_SMALL


def test_cli_publishes_all_dashboards(spark):
    out = new_run_dir(spark, "test-cli")
    paths = main(["--driver-tables", SF_SMALL, "--out", f"{out}/dash", "--work", f"{out}/work",
                  "--first", "1996-01-01", "--questionnaire-offset", "-24"])
    assert len(paths) == 7
    counts = {name: spark.read.parquet(p).count() for name, p in paths.items()}
    assert all(n > 0 for n in counts.values()), counts


def test_cli_publishes_snapshots_and_clears_its_working_folder(spark):
    out = new_run_dir(spark, "test-cli")
    before = folders(spark)
    paths = main(["--driver-tables", SF_SMALL, "--out", f"{out}/dash", "--first", "1996-01-01", "--atomic",
                  "--questionnaire-offset", "-24"])
    for name, path in paths.items():
        table = SnapshotTable(spark, path).read()
        assert table.count() > 0 and table.columns == struct(DASHBOARD_SCHEMAS[name]).names
    assert not [f for f in folders(spark) - before if f.startswith("monthly-refresh")]


def folders(spark):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/pathwise")
    return {s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)}
