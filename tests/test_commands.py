"""Every command on small files."""

import pytest
from pyspark.sql import functions as F

from spliceframe.__main__ import COMMANDS, main
from spliceframe.plans.carriers import Carriers
from spliceframe.sources.files import Bundle

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def there(spark, tmp_path_factory):
    """A folder with a bundle, reads, two tissues' GFF files, groups, a classification and barcode statistics."""
    d, c = tmp_path_factory.mktemp("commands"), Carriers(spark, SMALL)
    Bundle(c.counts, c.obs, c.var).write(str(d / "bundle"))
    spark.createDataFrame([(i, f"c{i % 3}", f"u{i % 4}") for i in range(24)] + [(99, None, "u")], "qname long, cb string, umi string").write.parquet(str(d / "reads"))
    exon = lambda t, a, b: f'chr1\tx\texon\t{a}\t{b}\t.\t+\t.\tgene_id "g"; transcript_id "{t}";\n'
    for tissue, text in (("skin", exon("P.1", 1, 9) + exon("P.1", 20, 30) + exon("P.2", 5, 8)), ("lung", "# comment\n" + exon("P.7", 5, 8) + exon("P.8", 6, 8))):
        (d / tissue).mkdir()
        (d / tissue / "x.gff").write_text(text)
    (d / "groups.tsv").write_text("PB.1\tskin|P.1,lung|P.7\nPB.2\tskin|P.2\n")
    (d / "classes.tsv").write_text("isoform\tcategory\n1\tfull\n2\tNA\n")
    (d / "stats.tsv").write_text("barcode\treads\treal_cell\nc0\t50\tcell\nc1\t30\tcell\nc2\t20\tcell\nc3\t99\tnoise\n")
    return d


def run(spark, there, command, *args):
    out = str(there / f"out-{command}")
    main([command, *(str(there / x) for x in args if not x.startswith("-")), out, *(x for x in args if x.startswith("-"))])
    return spark.read.parquet(out)


def test_ids(spark, there):
    ids = lambda df: {(r.tissue, r.old_id): r.new_id for r in df.collect()}
    assert ids(run(spark, there, "sync", "skin/x.gff", "lung/x.gff")) == {("lung", "P.7"): "PB.sync.1", ("skin", "P.2"): "PB.sync.1", ("lung", "P.8"): "PB.sync.2", ("skin", "P.1"): "PB.sync.3"}
    assert ids(run(spark, there, "pool", "skin/x.gff", "lung/x.gff", "--order=skin,lung")) == {("skin", "P.1"): "PB.pool.1", ("skin", "P.2"): "PB.pool.2", ("lung", "P.7"): "PB.pool.2", ("lung", "P.8"): "PB.pool.3"}
    assert {tuple(r) for r in run(spark, there, "recol", "groups.tsv", "--tissue=skin").collect()} == {("PB.1", "P.1"), ("PB.2", "P.2")}


def test_shards(spark, there):
    assert {tuple(r) for r in run(spark, there, "plan", "stats.tsv", "--shards=2").collect()} == {("c0", 0), ("c1", 1), ("c2", 1)}
    x = run(spark, there, "split", "reads", "out-plan")
    assert {(r.shard, r.cb): r["count"] for r in x.groupBy("shard", "cb").count().collect()} == {(0, "c0"): 8, (1, "c1"): 8, (1, "c2"): 8}


def test_tables(spark, there):
    got = {r.feature_id: r.class_category for r in run(spark, there, "classify", "bundle/var", "classes.tsv").filter("feature_id in (1, 2, 3)").collect()}
    assert got == {1: "full", 2: None, 3: None}
    assert {r.cb for r in run(spark, there, "saturation", "reads").collect()} >= {"c0", "c1", "c2"}
    assert run(spark, there, "rarefaction", "reads").count() == 10
    assert run(spark, there, "subsample", "reads", "--most=5").groupBy("cb").count().agg(F.max("count")).first()[0] == 5
    for command in ("fractions", "entropy", "usage", "one-vs-rest"):
        assert len(run(spark, there, command, "bundle").columns) > 3
    assert len(COMMANDS) == 13
