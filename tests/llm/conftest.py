"""Tables with awkward rows; the session is that of the tests around."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Texts with the awkward cases: null, empty, blank, very long, repeated, ties.
TEXTS = [None, "", " \t\n", "one", "one two", "a b c d", "a b c d", "The  MIT License, mit\nLicense",
         "x" * 30_000, "lorem ipsum dolor " * 4000, "don't we'll I've <|endoftext|> y'all's  \n\n  end ",
         "é ü ñ ß 日本語   １２ ½ 😀 é", "no\x1cbreak\x85next", "tail  ", "'s 's 'sx 'll'll '' '"]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, repeated rows and clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", 0, "x", i) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "null id", None, None, None, None, None), (None, None, None, None, None, None, None),
             (3, "another three", "de", "s0", 1, "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score string, size long")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def brute_components(n, linked):
    """Smallest index reachable for each of ``n`` nodes over ``linked(i, j)``."""
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
