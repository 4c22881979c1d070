from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest

WORDS = "le la und der the of and to in red blue ox éa ß x1 run-on a,b C# 中文 que vi".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", str(r.randrange(99))]) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(10**6)}" if r.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    """Null, empty and blank texts, short and very long ones, copies, near copies, shared passages, odd characters."""
    base, passage = prose(1, 120), prose(2, 60)
    out = [None, "", "   ", "\n\t", "a", "A b c d", "a b c d e", "a  b\nc d e", "...!", "中", "x" * 3000, prose(3, 20_000)]
    out += [base, base, base.upper(), edited(base, 1, 0.01), edited(base, 2, 0.02), edited(base, 3, 0.1), edited(base, 4, 0.3)]
    out += [f"{prose(s, 40)} {passage} {prose(s + 100, 40)}" for s in range(10, 18)]
    out += ["same line here\n" * 12 + prose(5, 30), "dup words again and again " * 9, "### $$$ %%% " + prose(6, 40), f"{passage}\n{passage}\n{passage}"]
    out += [prose(s, s) for s in range(1, 30)]
    chain = prose(7, 200).split(" ")
    out += [" ".join(chain[k : k + 150]) for k in (0, 12, 24, 36, 48)]  # neighbours link, the ends do not
    return out


@pytest.fixture(scope="session")
def documents(spark, texts):
    rows = [(k, t, "abcd"[k % 4] if t else None, f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, prose(2, 60)), (2, prose(2, 60).split(" ", 20)[-1]), (3, "a b"), (4, None), (5, "..."), (6, prose(99, 30)), (10, "ß"), (7, prose(2, 60))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture
def sql(spark):
    """Run DuckDB on Spark frames; the sorted rows, columns by name."""

    def run(query: str, **tables):
        connection = duckdb.connect()
        for name, frame in tables.items():
            connection.register(name, frame.toArrow() if not isinstance(frame, pa.Table) else frame)
        return rows_of(connection.sql(query).to_arrow_table())

    return run


def rows_of(frame) -> list[tuple]:
    table = frame if isinstance(frame, pa.Table) else frame.toArrow()
    table = table.select(sorted(table.column_names))
    return sorted((tuple(r.values()) for r in table.to_pylist()), key=repr)
