"""Documents with every awkward case, and words to make more of them."""

import random

from pyspark.sql import Row

CLASHING = ("kept", "n", "score", "verdict", "bucket", "t1", "mix_p", "lines_to_drop", "line", "node", "key_1")


def prose(seed, n, width=2000):
    r = random.Random(seed)
    return " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in
                    (r.randrange(width) for _ in range(n)))


def awkward_texts():
    long = prose(1, 6000)
    edited = prose(2, 300).split()
    edited[7] = "other"
    return [
        None, "", " \n\t ", "one", "two words", "same same same", long, long, long + " tail",
        prose(2, 300), " ".join(edited), prose(2, 300), prose(3, 60).upper(), prose(3, 60), "é漢字 ü x 😀" * 9,
        "a" * 5000, "Mail a.b+c@x-y.example.org, 10.0.0.1 or +1 (555) 123-4567; 4111 1111 1111 1111.",
        "x\ny\nx\n\ny", "0 " * 40, "&amp; <s> [INST] </s>",
    ]


def frame(spark, texts, ids=None):
    """documents with extra columns whose names operators use inside."""
    ids = ids or [None if k == 3 else k for k in range(len(texts))]
    rows = [Row(doc_id=i, text=t, lang="en" if i is None or i % 3 else None, source=f"s{(i or 0) % 2}", n_chars=len(t or ""),
                **{c: 7 for c in CLASHING}) for i, t in zip(ids, texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"{c} int" for c in CLASHING)
    return spark.createDataFrame(rows, schema)
