"""Tables with the awkward rows that every operator has to stand."""

from __future__ import annotations

import random

DOC_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use inside.
    "row long, key string, n string, kept string, spans string, digest string, part string, at string, "
    "c0 string, token string, component string, rank string, id string, base string, `__text` string"
)
_EXTRA = ("x",) * 14


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def texts(seed: int = 5) -> list[str | None]:
    rng = random.Random(seed)
    base = words(rng, 260)
    passage = words(rng, 60)
    near = base.split()
    near[40] = "changed"
    near[200] = "too"
    out: list[str | None] = [
        None,
        "",
        " \n\t ",
        "one two",
        "One  TWO",
        base,
        base,
        base.replace(" ", "\n", 3) + "  ",
        " ".join(near),
        base.upper(),
        words(rng, 80) + " " + passage + " " + words(rng, 50),
        words(rng, 30) + " " + passage,
        "x" * 30_000,
        "ab" * 4_000 + " end",
        words(rng, 6_000),
        "mail a.b@mail7.example.com, +1 (132) 555-1352 at 233.254.104.120; 4111 1111 1111 1111 é日本 a@b 300.1.1.1",
        "call 132-555-1352 or joe [at] example [dot] com. 4111111111111112",
        "日本語のテキスト 👩‍👩‍👧 café naïve <|endoftext|>  tail  ",
        "+1" * 500 + "@" * 500 + "1.2.3.4.5.6.7.8",
    ]
    out += [words(rng, rng.randint(1, 120)) for _ in range(25)]
    out += ["the very same line"] * 9
    return out


def documents(spark):
    rows = []
    for i, t in enumerate(texts()):
        rows.append((i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else ("hot" if i % 3 else f"s{i % 5}"), None if t is None else len(t), i, *_EXTRA))
    rows.append((None, "a row without an id", None, None, None, None, *_EXTRA))
    rows += [rows[5], rows[5], rows[20]]  # repeated rows
    assert len(rows[0]) == len(DOC_SCHEMA.split(","))
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
