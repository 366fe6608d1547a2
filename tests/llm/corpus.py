"""Small documents with the odd cases: nulls, empty and long texts, copies, repeated ids and rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tag string, row int, spans int, id string, "
          "text_a string, score double")
WORDS = [a + b for a in "ba ke li mo nu sa te vi xo zu".split() for b in "ran del fix gor mal pet".split()]


def prose(seed: int, n: int) -> list[str]:
    pick = random.Random(seed)
    return [pick.choice(WORDS) for _ in range(n)]


def changed(words: list[str], seed: int, n: int) -> list[str]:
    pick, words = random.Random(seed), list(words)
    for _ in range(n):
        words[pick.randrange(len(words))] = pick.choice(WORDS)
    return words


def texts() -> list[tuple[int | None, str | None]]:
    base, passage = prose(1, 120), prose(2, 60)
    rows: list[tuple[int | None, str | None]] = [(i, " ".join(prose(100 + i, 40 + 7 * i))) for i in range(12)]
    rows += [(20, " ".join(base)), (21, " ".join(base)), (22, " ".join(changed(base, 3, 1))), (23, "  ".join(base))]
    rows += [(30 + i, " ".join(prose(200 + i, 30) + passage + prose(300 + i, 25))) for i in range(5)]
    rows += [(40, None), (41, ""), (42, " \t\n"), (43, "!!! ???"), (44, "one two three"), (45, "one two three")]
    rows += [(50, "shti " * 900), (51, "shti " * 400 + "é" * 300), (52, " ".join(prose(9, 20000)))]
    rows += [(None, " ".join(base)), (None, None), (60, "same row twice " * 30), (60, "same row twice " * 30)]
    rows += [(61, " ".join(prose(71, 50))), (61, " ".join(prose(72, 50)))]
    rows += [(70, "Ünïcode ΣΑΣ 日本語 <|endoftext|> don't I'LL 12½ 😀 J̌  x\x1cy")]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, None if i is None else ("aa", "bb")[i % 2], None, None if t is None else len(t), "t", 1, 2, "x", None, 0.5)
         for i, t in rows], SCHEMA)


def collected(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=repr)
