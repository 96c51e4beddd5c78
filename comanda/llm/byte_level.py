"""What byte-level BPE vocabularies in the tokenizers library's files have in common."""

from __future__ import annotations

import json
from dataclasses import dataclass

import regex

# White_Space of Unicode, which \s means in the files' patterns.
BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Blanks, letters (\p{L}) and numbers (\p{N}) among the first 256 characters. Most
# texts need no others, and a pattern of these is several times as fast.
LATIN_BLANK = r"\t-\r \x85\xa0"
LATIN_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
LATIN_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"

# Letters and numbers of later Unicode versions than the tokenizer
# libraries' tables; the regex module has them, theirs have not.
LATER_LETTERS = (
    r"\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    r"\uab6c\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    r"\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2\U00016ff3"
    r"\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    r"\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    r"\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed"
    r"\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    r"\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LATER_NUMBERS = r"\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"


def is_latin(text: str) -> bool:
    """Whether all characters are among the first 256."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself, the other bytes for U+0100 onwards.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = byte_letters()
_BYTES = {c: b for b, c in LETTERS.items()}


def to_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(LETTERS)


def to_bytes(letters: str) -> bytes:
    return bytes(_BYTES[c] for c in letters)


@dataclass(frozen=True)
class Vocabulary:
    """Token ids by string, merges (left id, right id, made id) by rank, special ids."""

    ids: dict[str, int]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]

    def split_special(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at the odd places."""
        if not self.special or not any(s in text for s in self.special):
            return [text]
        longest = sorted(self.special, key=len, reverse=True)
        return regex.split("(" + "|".join(map(regex.escape, longest)) + ")", text)


def read_vocabulary(spec: str) -> Vocabulary:
    """Read a tokenizers file's contents. Merges come as pairs or as 'left right'."""
    parsed = json.loads(spec)
    ids = parsed["model"]["vocab"]
    suffix = parsed["model"].get("continuing_subword_prefix") or ""
    if suffix:
        raise ValueError("continuing_subword_prefix is not supported")
    merges = []
    for pair in parsed["model"]["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.append((ids[left], ids[right], ids[left + right]))
    special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    return Vocabulary(ids, merges, special)
