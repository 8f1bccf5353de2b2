"""Texts and helpers shared by the tests of this folder."""

import re

TRICKY = [
    None, "", " ", "\n\t ", "one", "Two words", "a b c d e", "x " * 40, "\n".join(["same line here"] * 6),
    "été à la plage, naïve façade — “quoted”", "日本語 のテキスト です", "###$$$ %%% &&&", "THE!! SHOUT!! OF!! ALL!!",
    "don't we'll I'm  double  spaces\r\nline", "<|endoftext|> is text", "😀 emoji 👩‍👩‍👧 family",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
