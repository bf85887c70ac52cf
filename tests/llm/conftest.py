import random

import pytest

#: Columns with names that operators use themselves.
CLASHES = ("size", "target", "taken", "key", "row", "n", "name", "kept", "held_out", "score", "word", "cleaned", "label", "component_id", "slot", "shard")


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    """Ordinary texts, odd ones, near copies, copies."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "delta.", "épée", "zeta", "eta", "42", "theta;", "iota", "x", "kappa\tlambda"]
    out: list[str | None] = [None, "", " ", "\n\n", "one", "two words", "a b c", "A\x0bB\x0cc d", "q" * 3000, "same " * 400]
    for _ in range(n):
        out.append(" ".join(r.choice(words) + r.choice(["", "", "\n"]) for _ in range(r.randint(1, 120))))
    base = [f"{r.choice(words)}{i}" for i in range(300)]
    out.append(" ".join(base))
    for _ in range(6):
        copy = list(base)
        for _ in range(r.randint(0, 6)):
            copy[r.randrange(300)] = "changed" + str(r.randrange(9))
        out.append(" ".join(copy))
    out += [out[-1], out[12], out[12], "common footer line of this host\n" + out[13], "common footer line of this host\n" + out[14]]
    return out


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"src{i % 4}", len(t or "")) for i, t in enumerate(texts())]
    return rows + [rows[12], rows[12], rows[3]]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    frame = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    frame.selectExpr("*", *(f"'odd' AS `{c}`" for c in CLASHES)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("doc_id < -1")
