from pyspark.sql import functions as F

from grovespark.functions import codecs
from grovespark.model import ALIASES, NODES, SYNONYMS, Taxonomy
from grovespark.operators import tree
from grovespark.sources import interim


def test_interim_round_trip(spark, tmp_path):
    d = tmp_path / "tax"
    d.mkdir()
    (d / "taxonomy.tsv").write_text("uid\t|\tparent_uid\t|\tname\t|\trank\t|\tsourceinfo\t|\tflags\t|\t\n1\t|\t\t|\tlife\t|\tno rank\t|\t\t|\t\t|\t\n2\t|\t1\t|\tFelidae\t|\tfamily\t|\tncbi:9681,IF:7\t|\textinct,hidden_inherited\t|\t\n2\t|\t1\t|\trepeat\t|\tfamily\t|\t\t|\t\t|\t\n3\t|\t9\t|\tWrongae\t|\tgenus\t|\t\t|\t\t|\t\n")
    (d / "synonyms.tsv").write_text("uid\tname\ttype\n2\tCats\tcommon name\n2\tFelidae\tsynonym\n2\tX\tauthority\n8\tLost\tsynonym\n")
    t = interim.read_taxonomy(spark, str(d), "t")
    got = {r["uid"]: (r["parent_uid"], r["name"], r["rank"], r["proper_flags"], r["inferred_flags"]) for r in t.nodes.collect()}
    assert got == {"1": (None, "life", "no rank", 0, 0), "2": ("1", "Felidae", "family", 1 << 17, 1 << 16), "3": ("9", "Wrongae", "no rank", 0, 0), "9": (None, "t:9", "no rank", 0, 0)}
    assert [tuple(r) for r in t.synonyms.select("uid", "name").collect()] == [("2", "Cats")]
    interim.write_taxonomy(t, str(tmp_path / "out"))
    again = interim.read_taxonomy(spark, str(tmp_path / "out"), "t")
    assert {tuple(r) for r in again.nodes.select("uid", "parent_uid", "name", "proper_flags").collect()} == {tuple(r) for r in t.nodes.select("uid", "parent_uid", "name", "proper_flags").collect()}


def test_names_and_cycles(spark):
    names = spark.createDataFrame([("Élan",), ("plain",), (None,)], "name string")
    assert {tuple(r) for r in codecs.normalize_names(names).collect()} == {("Élan", "Elan"), ("plain", "plain"), (None, None)}
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None)], "uid string, parent_uid string")
    assert {r["uid"] for r in tree.with_path(loop).where(F.col("path").isNull()).collect()} == {"a", "b"}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(20)] + [("x", "y"), ("y", "x")], "id string, replacement string")
    got = {r["id"]: r["replacement"] for r in tree.resolve_aliases(chain).collect()}
    assert got == {str(i): "20" for i in range(20)}


def test_a_row_that_looks_like_a_header_is_a_row(spark, tmp_path):
    (tmp_path / "taxonomy.tsv").write_text("uid\t|\tparent_uid\t|\tname\t|\trank\t|\t\n1\t|\t\t|\tlife\t|\tno rank\t|\t\nuid\t|\t1\t|\tname\t|\tgenus\t|\t\n")
    got = {(r["uid"], r["parent_uid"], r["name"]) for r in interim.read_nodes(spark, str(tmp_path / "taxonomy.tsv")).collect()}
    assert got == {("1", None, "life"), ("uid", "1", "name")}


def test_unique_names_are_written(spark, tmp_path):
    nodes = [("1", None, "life", "no rank", [], 0, 0), ("2", "1", "Plantae", "kingdom", [], 0, 0), ("3", "1", "Animalia", "kingdom", [], 0, 0), ("4", "2", "Aus", "genus", [], 0, 0), ("5", "3", "Aus", "no rank", [{"prefix": "x", "id": "9"}], 0, 0)]
    tax = Taxonomy(spark.createDataFrame(nodes, NODES), spark.createDataFrame([("4", "Bus", "synonym"), ("3", "Metazoa", None), ("8", "Lost", "synonym"), ("3", None, "synonym")], SYNONYMS), spark.createDataFrame([], ALIASES), "t")
    interim.write_taxonomy(tax, str(tmp_path / "out"))

    def fields(name):
        return sorted(tuple(r["value"].split("\t|\t"))[:-1] for r in spark.read.text(str(tmp_path / "out" / name)).collect())

    assert {(f[0], f[3], f[5]) for f in fields("taxonomy.tsv")} == {("uid", "rank", "uniqname"), ("1", "no rank", ""), ("2", "kingdom", ""), ("3", "kingdom", ""), ("4", "genus", "Aus (genus in Plantae)"), ("5", "no rank - terminal", "Aus (in Animalia)")}
    assert fields("synonyms.tsv") == [("Bus", "4", "synonym", "Bus (synonym for Aus (genus in Plantae))", ""), ("Metazoa", "3", "synonym", "Metazoa (synonym for Animalia)", ""), ("name", "uid", "type", "uniqname", "sourceinfo")]
    again = interim.read_taxonomy(spark, str(tmp_path / "out"), "t")
    assert {tuple(r) for r in again.synonyms.collect()} == {("4", "Bus", "synonym"), ("3", "Metazoa", "synonym")}
