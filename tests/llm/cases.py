"""Rows that every operator must bear, and small helpers."""

import re

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))  # about 0.7 MB, longer than most blocks
CLASH = ["size", "shard", "slot", "score", "lang_pred", "row_number", "key", "class", "n", "token", "_part", "taken", "host", "held_out",
         "rule", "verdict", "bad_odds", "url", "item_id", "start", "_h", "_p", "_more", "_place", "__part", "__start", "part", "plan_source", "__source", "__target", "__cut", "_id", "_time", "ident", "print", "place"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


EDGES = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta.", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \t\n\x0b ", "de", "b"),
    (None, "Alpha beta gamma delta epsilon zeta eta theta.", "en", None), (5, "one", "en", "b"), (6, "one", "en", "b"),
    (7, "tie tie tie tie tie tie tie tie tie tie tie tie", "de", "a"), (7, "tie tie tie tie tie tie tie tie tie tie tie tie", "de", "a"),
    (8, LONG, "en", "a"), (9, "Ünïcödé ßtraße   naïve space 你好 世界 \U0001f600", None, "ä"), (10, "!!! 123 ---", "en", "b"), (None, None, None, None),
    (11, "a\x00b nul inside", "en", "b"), (12, "x" * 70_000, "en", "b"),
]
