"""Small tables with every awkward case: nulls, empty and very long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, class_id long, spans string"


def prose(rng: random.Random, n: int, vocabulary: str = "en") -> str:
    pool = {
        "en": "the of and river stone light house under never green walking yellow morning bread window the and of",
        "de": "der die und nicht straße über grün könnte haus wasser schön morgen fenster zwischen der und die",
        "fr": "le la et où était garçon être maison très été fenêtre lumière matin après le et la",
    }[vocabulary].split()
    return " ".join(rng.choice(pool) + rng.choice(["", "", "s", "en", "er", "ing", str(rng.randrange(1000))]) for _ in range(n))


def awkward(spark, seed: int = 1):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, prose(rng, rng.randrange(20, 200), lang), lang, ("a", "b", "c", None)[i % 4]))
    base = rows[5][1]
    rows += [(100, None, "en", "a"), (101, "", "en", "a"), (102, " \t\n", None, "b"), (103, "!!! 123 ...", None, None), (104, "word", "en", "c")]
    rows += [(105, base, "fr", "a"), (106, base.replace(" ", "  \n"), "fr", "b"), (107, base + " tail", "fr", "b")]
    rows += [(108, " ".join(["again"] * 300), "en", "c"), (109, "x" * 30_000 + " " + prose(rng, 30_000), "en", "a")]
    rows += [rows[7], rows[7]]  # repeated rows
    rows += [(None, prose(rng, 50), None, None), (None, base, "fr", "a")]
    full = [(d, t, lang, s, None if t is None else len(t), -1, False, -5, "x") for d, t, lang, s in rows]
    return spark.createDataFrame(full, SHAPE)


def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
