"""Tables and rows that several tests use."""

SF = "/root/testdata/sf0.001"


def rows(spark, name, *names):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*names).collect()]


# Names that the operators use themselves, as further columns of the input.
CLASHING = "row id text_hash h words w0 s fp window hit_id hit_hash spans chars key class_id node bands place".split()

PROSE = " ".join(f"word{i} and other{i * 7 % 31}" for i in range(60))
#: Nulls, empty and white texts, ties and repeated rows, one long text, no id.
ODD = [
    (None, None),
    (None, PROSE),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one"),
    (5, PROSE),
    (5, PROSE),
    (6, PROSE + " more"),
    (7, "é" * 40 + "\U0001f600 " + "x" * 70_000 + " end"),
    (8, PROSE.upper()),
]
