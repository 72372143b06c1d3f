import random

import pytest

SF001, SF0001 = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("row_id", "text_key", "fp", "sig", "shard", "size", "score", "length", "words", "part", "rank", "removed_lines", "emptied", "_removed",
         "_id", "_key", "_text_key", "id", "text_hash", "_right_id", "removed", "row", "lang_pred", "toxic", "key", "spans", "item", "n", "token")


@pytest.fixture(scope="session")
def llm_spark(spark):
    from marquee.llm.common import prepare
    return prepare(spark)


@pytest.fixture(scope="session")
def make_docs(llm_spark):
    def make(rows, clash=False):
        df = llm_spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows], SCHEMA)
        if clash:
            for c in CLASH:
                df = df.selectExpr("*", f"concat('x', doc_id) as `{c}`")
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, blanks, ties, repeated rows and ids, a very long text."""
    rnd = random.Random(3)
    words = ["the", "of", "and", "Ähre", "été", "zwölf", "run", "lamp", "x1", "STONE", "river", "fern", "a"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    long = "\n".join(text(rnd.randint(1, 30)) for _ in range(3000))
    rows = [(1, None), (2, ""), (3, "   \n\n "), (4, "..."), (5, "one"), (6, "one"), (6, "one"), (7, text(40)), (None, text(12)), (None, None), (8, long), (9, long), (10, "\n".join([text(20)] * 3))]
    rows += [(i, "\n".join(text(rnd.randint(1, 25)) for _ in range(rnd.randint(1, 5)))) for i in range(20, 60)]
    base = rows[-1][1]
    rows += [(100 + i, base + f"\nextra {i} words here that differ {i}") for i in range(8)] + [(200 + i, base) for i in range(5)]
    return rows
