import random

import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, short, long and repeated rows, null ids, and extra
    columns whose names operators might use themselves."""
    rnd = random.Random(5)
    words = "the of and rain in Spain falls mainly on plain día größe façade 北京 42 x86".split()
    text = " ".join(rnd.choices(words, k=300))
    long = " ".join(rnd.choices(words, k=60_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "One"), (6, "one two three"),
            (7, text), (8, text), (8, text), (9, text.upper()), (10, text.replace(" ", "\n")),
            (11, text + " tail"), (12, long), (13, long + "!"), (14, long), (None, text), (None, None),
            (15, "  x "), (16, "12 34 !!! ???"), (17, "a" * 5000), (18, "  two  spaces  "),
            (19, "<|endoftext|> a <|endoftext|>b"), (20, "the\x00nul\x1f and \x85 next")]
    rows += [(100 + i, " ".join(rnd.choices(words, k=rnd.randint(1, 40)))) for i in range(40)]
    rows += [(200 + i, f"same passage {'again and ' * 30}end") for i in range(60)]
    data = [(i, t, "en" if k % 3 else "fr", f"s{k % 2}", len(t or ""), k, "k", True, 1.5)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, name int, fp string, kept boolean, n double"
    ).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def rows_of():
    def get(df, *columns):
        def key(row):
            return tuple((v is None, str(v)) for v in row)
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    return get
