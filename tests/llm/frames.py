"""Small inputs for the operators of cargolens.llm."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, in other cases too.
CLASHING = (
    "slot", "Found", "q", "cut", "key", "content", "gone", "number", "length", "piece", "at",
    "task", "n", "row", "node", "component", "spans", "score", "size",
)

_SYLLABLES = {
    "en": "the and ing tion er re th on est ly".split(),
    "de": "der und sch keit ein ung ge ver ich zu".split(),
    "fr": "le des eau que eux oir ment aux tre ou".split(),
}


def words(rng: random.Random, lang: str, n: int) -> list[str]:
    return ["".join(rng.choices(_SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)]


def prose(rng: random.Random, lang: str = "en", n: int = 60) -> str:
    """Lines of sentences."""
    found = words(rng, lang, n)
    lines = [found[i : i + 12] for i in range(0, n, 12)]
    return "\n".join(" ".join(line).capitalize() + "." for line in lines)


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """Prose in three languages with exact copies, edited copies and shared passages."""
    rng = random.Random(seed)
    rows = []
    passage = " ".join(words(rng, "en", 70))
    for i in range(n):
        lang = rng.choice(list(_SYLLABLES))
        text = prose(rng, lang, rng.choice([8, 40, 120]))
        if i % 7 == 3 and rows:
            text = rng.choice(rows)[1]
        elif i % 7 == 5 and rows:
            old = rng.choice(rows)[1].split(" ")
            old[rng.randrange(len(old))] = "changed"
            text = " ".join(old)
        elif i % 7 == 6:
            text = f"{text} {passage} {prose(rng, lang, 15)}"
        rows.append((100 + i, text, lang, f"src{i % 3}", len(text)))
    return rows


def edges() -> list[tuple]:
    """Nulls, empty and very long texts, repeated rows and ids, odd characters."""
    rng = random.Random(5)
    long = " ".join(words(rng, "en", 30_000))
    some = "one two three four five six seven"
    texts = [
        (1, None), (2, ""), (3, " \t\r\n "), (4, "one two"), (5, "one two"), (5, "one two"),
        (6, some), (6, "other words under the same document number here"), (None, some), (None, None),
        (7, long), (8, long), (9, "a" * 3000), (10, "Der Der Der " * 60), (11, "▁ ▁▁x <|endoftext|> </s>"),
        (12, "Ünïcödé 文字列 ΣΑΣ İstanbul ﬁ é \U0001f600"), (13, "1234 5678 !!! ???"), (14, " leading  and   trailing  "),
        (None, long[:5000]), (2**62, "x\x00y\x1cz\x85w\xa0v"),
    ]
    rows = [(i, t, None if k % 3 == 0 else "en", None, None) for k, (i, t) in enumerate(texts)]
    return rows + rows[-3:]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """Further columns with names that operators might use themselves."""
    return docs.selectExpr("*", *[f"'{name}' AS `{name}`" for name in CLASHING])


def folder(docs: DataFrame, path, table: str = "documents") -> str:
    """A folder of tables as the queries read it."""
    docs.write.parquet(f"{path}/{table}.parquet")
    return str(path)
