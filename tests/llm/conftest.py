import pytest

PROSE = (
    "the river ran past the old mill and the children threw stones into the slow water while "
    "their mother read a long letter from the city about the price of bread and the cold winter"
)
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp string, size string, "
    "score string, copies string, shard string, slot string, kept string, component_id string, piece string, "
    "_row string, _key string, _old string, _own string, _m string, _mark string, _copies string, _file string, _before string"
)


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None, *["x"] * 18)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, copies, and columns with clashing names."""
    rows = [
        row(1, PROSE), row(2, PROSE), row(2, PROSE), row(3, PROSE.replace("bread", "salt"), "b"),
        row(4, None), row(5, ""), row(6, " \n\t "), row(7, "one"), row(7, "one"), row(None, "a null id", None),
        row(None, PROSE, None), row(8, "Ünïcode wörds " * 40, None), row(9, " ".join(f"w{i}" for i in range(30_000)), "b"),
        row(10, "x" * 100_000), row(11, "THE SAME\nTHE SAME\nTHE SAME\n" * 3, "c"), row(12, "#$%& | | <> ** " * 9, "c"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
