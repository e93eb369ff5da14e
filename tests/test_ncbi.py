"""A whole import of bar-separated dumps: names, sinking, skipped clades, and what is set aside."""

from grovespark.sources import ncbi


def text(path, rows):
    path.write_text("".join("\t|\t".join(r) + "\t|\n" for r in rows))


NODES = [
    ("1", "1", "no rank"), ("10", "1", "family"), ("11", "10", "genus"), ("12", "11", "subgenus"), ("13", "12", "species"), ("20", "10", "tribe"), ("21", "20", "subtribe"), ("22", "21", "genus"), ("23", "22", "species"),
    ("30", "1", "family"), ("31", "30", "no rank"), ("32", "31", "species"), ("40", "1", "order"), ("41", "40", "class"), ("50", "51", "genus"), ("51", "50", "genus"), ("60", "99", "genus"), ("70", "1", "genus"), ("71", "70", "species"),
    ("13", "12", "species"), ("80", "1", "species"), ("81", "1", "species group"),
]
NAMES = [
    ("1", "root", "", "scientific name"), ("10", "Aa", "", "scientific name"), ("11", "Bb", "", "scientific name"), ("12", "Bb", "Bb <subgenus>", "scientific name"), ("13", "Bb c", "", "scientific name"), ("13", "Bb d", "", "misspelling"),
    ("20", "Aa", "", "scientific name"), ("20", "old Aa", "", "synonym"), ("21", "Aa", "", "scientific name"), ("22", "Dd", "", "scientific name"), ("23", "Aa", "", "scientific name"), ("23", "part", "", "in-part"),
    ("30", "Ff", "", "scientific name"), ("31", "environmental samples", "", "scientific name"), ("32", "x", "", "scientific name"), ("40", "Gg", "", "scientific name"), ("41", "Hh", "", "scientific name"), ("41", "Ii", "", "synonym"),
    ("50", "Jj", "", "scientific name"), ("51", "Kk", "", "scientific name"), ("60", "Ll", "", "scientific name"), ("70", "", "", "scientific name"), ("70", "Nn", "", "synonym"), ("71", "Mm", "", "scientific name"), ("98", "Oo", "", "scientific name"),
    ("80", "Pp", "Pp <series>", "scientific name"), ("81", "Qq", "Qq subgroup <Rr>", "scientific name"), ("80", "Pp", "Pp <series>", "scientific name"),
]


def test_import(spark, tmp_path):
    text(tmp_path / "nodes.dmp", NODES)
    text(tmp_path / "names.dmp", NAMES)
    text(tmp_path / "merged.dmp", [("5", "10"), ("5", "10"), ("6", "11")])
    got = ncbi.load(spark, str(tmp_path), spark.createDataFrame([("40",), ("40",), ("no such",)], "uid string"))
    nodes = {r["uid"]: (r["parent_uid"], r["name"], r["rank"]) for r in got.taxonomy.nodes.collect()}
    assert nodes == {
        "1": (None, "life", "no rank"), "10": ("1", "Aa", "family"), "11": ("10", "Bb", "genus"), "12": ("11", "Bb subgenus Bb", "subgenus"), "13": ("12", "Bb c", "species"), "22": ("10", "Dd", "genus"),
        "23": ("22", "Aa family Aa species Dd genus", "species"), "30": ("1", "Ff", "family"), "31": ("30", "Ff environmental samples", "no rank"), "32": ("31", "x", "species"), "60": (None, "Ll", "genus"), "71": ("1", "Mm", "species"),
        "80": ("1", "Pp series", "species"), "81": ("1", "Qq subgroup Rr", "species group"),
    }
    assert sorted(tuple(r) for r in got.taxonomy.synonyms.collect()) == [("1", "Nn", "synonym"), ("10", "old Aa", "synonym"), ("13", "Bb d", "misspelling")]
    assert sorted(tuple(r) for r in got.taxonomy.aliases.collect()) == [("5", "10"), ("6", "11")]
    assert sorted(tuple(r) for r in got.problems.collect()) == [("50", "cycle"), ("51", "cycle"), ("70", "no scientific name"), ("98", "no node")]


def test_lineage_names_stop_at_a_renamed_node(spark):
    """Below a node renamed for its genus, ancestors above it don't count; the topmost below it does."""
    line = [("1", "1", "no rank", "root"), ("2", "1", "genus", "X"), ("3", "2", "subgenus", "X"), ("4", "3", "section", "Y"), ("5", "4", "series", "X"), ("6", "5", "form", "Z"), ("7", "6", "species", "X")]
    nodes = spark.createDataFrame([("\t|\t".join(r[:3]) + "\t|",) for r in line], "value string")
    names = spark.createDataFrame([("\t|\t".join((r[0], r[3], "", "scientific name")) + "\t|",) for r in line], "value string")
    got = ncbi.build(nodes, names, spark.createDataFrame([], "uid string"), nodes.limit(0)).taxonomy.nodes
    assert {r["uid"]: r["name"] for r in got.collect()} == {"1": "life", "2": "X", "3": "X subgenus X", "4": "Y", "5": "X", "6": "Z", "7": "X series X species Z form"}


def test_empty(spark):
    none = spark.createDataFrame([], "value string")
    got = ncbi.build(none, none, spark.createDataFrame([], "uid string"), none)
    assert [x.count() for x in (got.taxonomy.nodes, got.taxonomy.synonyms, got.taxonomy.aliases, got.problems)] == [0, 0, 0, 0]
