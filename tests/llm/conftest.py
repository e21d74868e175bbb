import pytest

# Columns that operators use as names of their own, to clash with.
EXTRA = ["size", "h", "node", "slot", "n", "lang_pred", "_q_kept", "start", "kept", "text_hash"]
LONG = " ".join(f"w{i % 977} {i}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "one", "Ab cd ef", "mail joe@ex.org or 10.0.0.1 now", LONG, "Same text here, twice. And more of it.\nLine",
         "Same text here, twice. And more of it.\nLine", "ünï cödé 漢字 🙂 <|endoftext|>", "a b\x1cc", "x" * 70_000]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows and clashing extra columns."""
    rows = [(None if i == 3 else i, t, None if i % 3 == 0 else "en", None if i % 4 == 1 else f"s{i % 2}",
             None if t is None else len(t), *[None if i % 2 else i] * len(EXTRA)) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[7], rows[1]]
    kinds = ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {kinds}")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return {r.doc_id: r for r in small.collect()}
