import pytest

CLASHING = ["fp", "node", "component_id", "key", "kind", "part", "data", "uid", "tokens", "epochs", "epoch", "score", "y", "_k", "_h", "dup", "times", "h1", "pii_kinds", "out", "domain", "row_seed", "held_out", "n"]
TEXT = "Call +1 (974) 555-3436 now. "
LONG = ("alpha beta " + "x" * 9000 + " gamma é 漢 ") * 30


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties and clashing extra columns."""
    rows = [
        (1, TEXT * 9, "en", "src1"), (1, TEXT * 9, "en", "src1"), (2, None, "en", "src1"), (3, "", None, None), (4, " \n\t ", "de", "src2"), (5, LONG, "fr", None),
        (None, "one two three four", "en", "src2"), (6, "one", None, "src1"), (7, TEXT * 9, "en", "src3"), (8, "▁ a▁b  c", "es", "src3"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").selectExpr("*", "cast(length(text) as bigint) as n_chars", *[f"'x' as `{c}`" for c in CLASHING])
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
