"""Column expressions over text: predicates, words, tokens, n-grams, rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What parts tokens besides white space.
TOKEN_SEPARATORS = "[\\s,;.‘’\"'()\\[\\]]+"
#: Lower-case substrings of error messages, by class.
RETRYABLE = ("503", "unavailable", "resource_exhausted", "quota", "rate", "limit", "429", "exhausted", "overloaded", "service unavailable", "too many requests")
RATE_LIMIT = ("quota", "rate", "limit", "429", "exhausted", "resource_exhausted")
QUOTA = ("429", "quota", "resource_exhausted", "rate limit", "too many requests", "ratelimitexceeded")
SERVER = ("500", "503", "unavailable", "internal server")


def strip_ws(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """Null, empty or white space alone: what counts as untranslated."""
    return F.coalesce(strip_ws(c), F.lit("")) == ""


def fold(c: Column, ascii_only: bool = False) -> Column:
    """Lower case, of all letters or of A-Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if ascii_only else F.lower(c)


def icontains(c: Column, query: str, wildcards: bool = False, ascii_only: bool = False) -> Column:
    """Case-insensitive substring search; with wildcards, % and _ in the query mean what they mean in LIKE."""
    if wildcards:
        folded = query.translate({c: c + 32 for c in range(65, 91)}) if ascii_only else query.lower()
        return fold(c, ascii_only).like("%" + folded.replace("\\", "\\\\") + "%")
    return F.contains(fold(c, ascii_only), fold(F.lit(query), ascii_only))


def any_of(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text, in lower case, contains one of the parts; null counts as empty."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(low, p))


def error_class(c: Column) -> dict[str, Column]:
    return {
        "retryable": any_of(c, RETRYABLE),
        "rate_limit": any_of(c, RATE_LIMIT),
        "kind": F.when(any_of(c, QUOTA), "quota").when(any_of(c, SERVER), "server").otherwise("other"),
    }


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")).cast("long")


def pieces(c: Column) -> Column:
    """The text parted at white space and TOKEN_SEPARATORS, empty pieces included."""
    return F.split(F.coalesce(c, F.lit("")), f"(?U){TOKEN_SEPARATORS}")


def tokens(c: Column) -> Column:
    """Distinct folded pieces of 3 to 39 characters."""
    return F.array_distinct(F.transform(F.filter(pieces(c), lambda t: (F.length(t) > 2) & (F.length(t) < 40)), F.lower))


def gram_pieces(c: Column) -> Column:
    """Folded pieces of two characters or more, in order."""
    return F.transform(F.filter(pieces(c), lambda x: F.length(x) > 1), F.lower)


def ngrams(c: Column, most: int = 5) -> Column:
    """Distinct runs of 1 to `most` folded pieces of two characters or more, joined by blanks; shorter pieces are dropped before."""

    def runs(t: Column) -> Column:
        def of(n: int) -> Column:
            starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1))).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))

        return F.array_distinct(F.concat(t, *(of(n) for n in range(2, most + 1))))

    # as a lambda's variable the pieces are made once, not anew for each run
    return F.element_at(F.transform(F.array(gram_pieces(c)), runs), 1)


def long_words(c: Column, least: int = 5) -> Column:
    """Distinct folded words of at least `least` letters, digits or Devanagari signs, in order of appearance."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"[\\p{{L}}\\p{{N}}_ऀ-ॿ]{{{least},}}"), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def est_tokens(c: Column) -> Column:
    """A token for each four characters."""
    return F.floor(F.length(F.coalesce(c, F.lit(""))) / 4).cast("long")


def safe_key(c: Column) -> dict[str, Column]:
    """File-name-safe keys: / and . as _, and everything but letters, digits, _ and - as _."""
    return {"path_key": F.translate(c, "/.", "__"), "file_key": F.regexp_replace(c, r"[^\p{L}\p{N}_\-]", "_")}


def reference_block(pali: Column, english: Column, most: int) -> Column:
    """Both texts under headings; English stays whole and the other is cut to the rest of `most` characters (-1: no limit)."""
    head, cut = "[Pāli] ", "[Pāli] ... [truncated]"
    p = F.concat(F.lit(head), F.replace(strip_ws(F.coalesce(pali, F.lit(""))), F.lit("ṁ"), F.lit("ṃ")))
    e = F.concat(F.lit("[English] "), strip_ws(F.coalesce(english, F.lit(""))))
    if most == -1:
        return F.concat(p, F.lit("\n\n"), e)
    room = F.lit(most) - F.length(e) - 2
    short = F.concat(strip_ws(F.substring(p, F.lit(1), F.greatest(F.lit(len(head)), room - 15))), F.lit(" … [truncated]"))
    body = F.when(F.length(e) >= most, F.lit(cut)).when(room <= len(head), F.lit(cut)).when(F.length(p) > room, short).otherwise(p)
    return F.concat(body, F.lit("\n\n"), e)


def gloss_format(c: Column) -> Column:
    """A gloss, a JSON array of {pali, meaning} or {note}, as one line; plain or malformed text stays, none is (none)."""
    text = strip_ws(c)
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    get = lambda v, k: F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit(""))

    def line(v: Column) -> Column:
        pali, meaning = get(v, "pali"), get(v, "meaning")
        note = F.try_variant_get(v, "$.note", "string")
        both = F.when((pali != "") & (meaning != ""), F.concat(pali, F.lit(": "), meaning)).otherwise(F.concat(pali, meaning))
        is_note = note.isNotNull() & ~F.schema_of_variant(v).rlike(r"\bpali:")
        return F.when(is_note, F.concat(F.lit("[Note: "), note, F.lit("]"))).otherwise(both)

    dicts = F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    joined = F.array_join(F.filter(F.transform(dicts, line), lambda x: x != ""), " | ")
    shown = F.when(joined == "", "(none)").otherwise(joined)
    return (
        F.when(F.coalesce(c, F.lit("")) == "", "(none)")
        .when(text.startswith("[") & items.isNotNull(), shown)
        .otherwise(text)
    )


def filled(template: str, fields: dict[str, Column]) -> Column:
    """The template with each {name} as that field's text; null is empty, and braces in a field mean nothing."""
    parts = re.split(r"\{(\w+)\}", template)
    texts = [F.coalesce(fields[x].cast("string"), F.lit("")) if i % 2 else F.lit(x) for i, x in enumerate(parts)]
    return F.concat(*texts)


def local_time(epoch: Column) -> Column:
    """Seconds since 1970 as date and time in the session's time zone; null stays."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd HH:mm:ss")


def id_list(c: Column) -> Column:
    """The whole numbers of a comma-separated list; null where there are none or a part is not a number, which means no restriction."""
    given = F.filter(F.transform(F.split(c, ","), strip_ws), lambda x: x != "")
    fits = (F.size(given) > 0) & F.forall(given, lambda x: x.rlike(r"^[+-]?\d+$"))
    return F.when(fits, F.transform(given, lambda x: x.cast("long")))
