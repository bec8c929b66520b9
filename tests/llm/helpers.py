"""Documents with every odd case the operators promise to handle."""

CLASHING = "group size digit next tag kept keep_id id bytes doc span gram stretch key rep n part block bucket number c0 text_ features".split()


def frame(spark, rows, extra=True):
    """`doc_id`, `text` and columns whose names clash with those used inside the operators."""
    columns = ["doc_id", "text", *(CLASHING if extra else [])]
    data = [(*r, *([str(r[0])] * (len(columns) - 2))) for r in rows]
    schema = "doc_id long, text string" + "".join(f", `{c}` string" for c in columns[2:])
    return spark.createDataFrame(data, schema)


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one two"),
    (6, LONG),
    (7, LONG + " end"),
    (8, "the same text"),
    (9, "the same text"),
    (9, "the same text"),
    (None, "the same text"),
    (None, None),
    (10, "Éa ß 日本 \U0001f600 tail"),
]
