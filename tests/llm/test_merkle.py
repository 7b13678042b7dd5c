import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from opinia.llm import catalogue, merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, slot string, node string, tree string, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shown(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """The top, and for each node what it meets: (before, after) a level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            other = nodes[k ^ 1] if k ^ 1 < len(nodes) else ""
            paths[leaf].append((other, "") if k % 2 else ("", other))
        nodes = [sha("".join(nodes[k : k + 2])) for k in range(0, len(nodes), 2)]
        at = [k // 2 for k in at]
    return nodes[0], paths


def brute(rows):
    """Of each row (leaf, subroot, root, path)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, sha("".join(map(shown, row)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, known = [], {}
    for g in order:
        top, paths = climb([leaf for *_, leaf in sorted(groups[g])])
        tops.append(top)
        known[g] = list(zip((leaf for *_, leaf in sorted(groups[g])), paths))
    root, high = climb(tops)
    return sorted((leaf, top, root, path + up) for g, top, up in zip(order, tops, high) for leaf, path in known[g])


def found_in(df):
    rows = df.collect()
    return sorted((r["leaf"], r["subroot"], r["root"], [(m["before"], m["after"]) for m in r["path"]]) for r in rows)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


CASES = {
    "one": [(1, "s", "en", 1, "a")],
    "two": [(1, "s", "en", 1, "a"), (2, "s", None, 1, "a")],
    "sizes": [(i, "s", f"l{n}", i, "t" * n) for n in (1, 2, 3, 5, 8, 9) for i in range(n)],
    "large": [(i * 7 % 1201, f"s{i % 3}", "en" if i % 9 else None, i, f"text {i} é") for i in range(1201)],
    "awkward": [(None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""), (1, "a", "", 0, ""), (2, "é ", "zh", -5, "x" * 500_000), (3, "=", "=", 1, "-")],
    "many groups": [(i, "s", f"g{i:04d}", 1, "t") for i in range(300)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_brute_force(spark, name):
    rows = CASES[name]
    for layout in (1, 5):
        assert found_in(merkle.manifest(table(spark, rows).repartition(layout), COLUMNS)) == brute(rows)


def test_equal_rows(spark):
    rows = [(5, "s", "en", 1, "same")] * 700 + [(i, "s", "de", 1, "t") for i in range(3)]
    assert found_in(merkle.manifest(table(spark, rows), COLUMNS)) == brute(rows)


def test_nothing(spark):
    assert merkle.manifest(table(spark, []), COLUMNS).count() == 0


def test_only_what_is_untouched_verifies(spark):
    rows = CASES["large"]
    touched = F.col("doc_id") % 5 == 0
    checked = merkle.manifest(
        table(spark, rows), COLUMNS, found={"text": F.when(touched, F.concat("text", F.lit("!"))).otherwise(F.col("text"))}
    ).withColumn("same", merkle.folded(F.col("found_leaf"), F.col("path")) == F.col("root"))
    assert checked.where((F.col("key") % 5 == 0) == F.col("same")).count() == 0


def test_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    own = catalogue.op12_merkle(spark, folder)
    assert {tuple(r) for r in own.collect()} == set(con.execute(catalogue.SQL["op12_merkle"]).fetchall())
    assert 0 < own.where("NOT verified").count() < own.count()
