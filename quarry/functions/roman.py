"""Pāli in Myanmar letters as Roman letters."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters of the script and what they stand for.
CONSONANTS = dict(
    zip(
        "ကခဂဃငစဆဇဈဉညဋဌဍဎဏတထဒဓနပဖဗဘမယရလဝသဟဠဿအ",
        "k kh g gh ṅ c ch j jh ñ ññ ṭ ṭh ḍ ḍh ṇ t th d dh n p ph b bh m y r l v s h ḷ ss".split() + [""],
        strict=True,
    )
)
MEDIALS = {"ျ": "y", "ြ": "r", "ွ": "v", "ှ": "h"}
VOWELS = dict(zip("ဣဤဥဦဧဩ", ("i", "ī", "u", "ū", "e", "o"), strict=True))
SIGNS = {"ါ": "ā", "ာ": "ā", "ိ": "i", "ီ": "ī", "ု": "u", "ူ": "ū", "ေ": "e"}
STACK, KILLER, ANUSVARA = "္", "်", "ံ"
OTHERS = {"၊": ",", "။": "."} | dict(zip("၀၁၂၃၄၅၆၇၈၉", "0123456789", strict=True))
#: Letters that other converters leave, as the usual ones.
FIXUPS = (("ï", "i"), ("ü", "u"), ("ĕ", "e"), ("ŏ", "o"), ("l̤", "ḷ"))


def from_myanmar(text: str) -> str:
    """Letter by letter: a consonant has the vowel a unless a sign, a stacked letter or the killer follows; what is not of the script stays."""
    out: list[str] = []
    open_ = None  # a consonant whose vowel is not known yet
    for i, c in enumerate(text):
        if c in MEDIALS and open_ is not None:
            open_ += MEDIALS[c]
        elif c in SIGNS:
            if c in "ါာ" and i and text[i - 1] == "ေ":
                out[-1] = out[-1][:-1] + "o"  # e and ā together
            else:
                out.append((open_ or "") + SIGNS[c])
                open_ = None
        elif c in (STACK, KILLER):
            out.append(open_ or "")
            open_ = None
        else:
            if open_ is not None:
                out.append(open_ + "a")
                open_ = None
            if c in CONSONANTS:
                open_ = CONSONANTS[c]
            else:
                out.append("ṃ" if c == ANUSVARA else VOWELS.get(c) or OTHERS.get(c, c))
    return "".join(out) + (open_ + "a" if open_ is not None else "")


def to_roman(c: Column, convert: Callable[[str], str] = from_myanmar) -> Column:
    """The text in Roman letters: one that begins with a Latin letter or a capital as it is, null as empty, any other by `convert`.

    Where convert fails, the text stays.
    """

    @F.pandas_udf("string")
    def converted(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if not text:
                return text
            try:
                made = convert(text)
            except Exception:  # noqa: BLE001  whatever a converter raises
                return text
            for old, new in FIXUPS:
                made = made.replace(old, new)
            return made or text

        return texts.map(one)

    text = F.coalesce(c, F.lit(""))
    return F.when((text == "") | text.rlike(r"^[\p{IsLatin}\p{Lu}]"), text).otherwise(converted(text))
