"""Small tables with the cases every operator must handle."""

import random

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def prose(rnd, n, size=400):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) + str(rnd.randrange(size)) for _ in range(n))


def edge_documents():
    """NULLs in every column, empty, blank and very long texts, ties, repeated rows, copies and near copies."""
    rnd = random.Random(5)
    passage = prose(rnd, 60)
    line = "The same Footer   line on every page"
    rows = [
        (None, None, None, None, None),
        (None, prose(rnd, 40), "en", "a", 1),
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b ", "en", None, 5),
        (4, "one", "en", "b", 3),
        (5, "One", "en", "b", 3),
        (6, "four words are here", "en", "b", 4),
        (7, "x " * 300, "en", "b", 600),
        (8, "a b  c \U0001f600 \x1c\x85 d e f g h i j k", "en", "", 9),
        (9, prose(rnd, 6000), "en", "a", 9),
        (10, "no" * 4000, "en", "c", 8000),
    ]
    for i in range(11, 41):
        body = prose(rnd, rnd.randint(12, 90))
        if i % 3 == 0:
            body = f"{body}\n{line}"
        if i % 4 == 0:
            body = f"{prose(rnd, 5)} {passage} {body}"
        rows.append((i, body, "en", rnd.choice(["a", "b", None]), len(body)))
    copy = prose(rnd, 120)
    for i in range(41, 47):
        rows.append((i, copy, "en", "a", 1))
    near = copy.split()
    for i in range(47, 51):
        near = near[:]
        near[i] = f"w{i}"
        rows.append((i, " ".join(near).upper() if i == 49 else " ".join(near), "en", "a", 1))
    rows += [rows[20], rows[20], rows[1]]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(edge_documents() if rows is None else rows, DOCS)
