"""Translation context: pending work, glosses, glossary overlap, linked commentary, definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import blank, gloss_format, gram_pieces, long_words
from quarry.operators.paragraphs import joined

LINE = ["book_id", "para_id", "line_id"]
NO_COMMENTARY = "(no commentary available)"
LABELS = {
    "full": "[Commentary & Sub-commentary - full paragraphs]",
    "window": "[Commentary & Sub-commentary - 3-line window]",
    "exact": "[Commentary & Sub-commentary - linked lines only]",
}


def chapter_paragraphs(headings: DataFrame) -> DataFrame:
    """(book_id, head_id, para_id): each heading's paragraphs, from its own over its chapter_len, 1 at least.

    Ranges are written out, so what follows joins by equality and a long book stays spread.
    """
    last = F.col("para_id") + F.greatest(F.coalesce("chapter_len", F.lit(1)), F.lit(1)) - 1
    return headings.select("book_id", F.col("para_id").alias("head_id"), F.explode(F.sequence(F.col("para_id"), last.cast("long"))).alias("para_id"))


def pending_sentences(sentences: DataFrame, column: str = "english") -> DataFrame:
    return sentences.filter(blank(F.col(column)))


def pending_headings(
    headings: DataFrame, sentences: DataFrame, overwrite: bool = False, batch: int | None = 50, sc_id: str | None = None, book_id=None
) -> DataFrame:
    """Headings with an untranslated line in their range (all, to overwrite), in order, `batch` at most.

    Of a given sc_id, or else of a given book, or else of all books; but for a given sc_id only headings that have one,
    where the table knows sc_ids.
    """
    df = headings
    if sc_id is not None:
        df = df.filter(F.col("sc_id") == sc_id)
    else:
        if "sc_id" in headings.columns:
            df = df.filter(F.col("sc_id").isNotNull() & (F.col("sc_id") != ""))
        if book_id is not None:
            df = df.filter(F.col("book_id") == book_id)
    if not overwrite:
        todo = pending_sentences(sentences).select("book_id", "para_id").distinct()
        hit = chapter_paragraphs(df).join(todo, ["book_id", "para_id"], "left_semi").select("book_id", F.col("head_id").alias("para_id")).distinct()
        df = df.join(hit, ["book_id", "para_id"], "left_semi")
    df = df.select("book_id", "para_id", "chapter_len").orderBy("book_id", "para_id")
    return df if batch is None else df.limit(batch)


def heading_workload(headings: DataFrame, sentences: DataFrame) -> DataFrame:
    """For each heading the paragraphs, lines and untranslated lines in its range."""
    lines = chapter_paragraphs(headings).join(sentences, ["book_id", "para_id"])
    paras = lines.groupBy("book_id", "head_id", "para_id").agg(F.count("*").alias("n"), F.count_if(blank(F.col("english"))).alias("todo"))
    return paras.groupBy("book_id", "head_id").agg(F.count("*").alias("paragraphs"), F.sum("n").alias("lines"), F.sum("todo").alias("pending"))


def reference_lookup(keys: DataFrame, references: DataFrame) -> DataFrame:
    """For each sc_id its reference's name and texts; without one the id is the name and the texts are empty."""
    first = references.groupBy("sc_id").agg(F.min(F.struct("sutta_name", "palitext", "entext")).alias("r"))
    df = keys.join(first, "sc_id", "left")
    name = F.coalesce(F.nullif(F.col("r.sutta_name"), F.lit("")), F.col("sc_id").cast("string"))
    return df.select(*keys.columns, name.alias("sutta_name"), *(F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in ("palitext", "entext")))


def overlap(rows: DataFrame, terms: str, glossary: DataFrame, key: list[str]) -> DataFrame:
    """The glossary's entries whose head is among an array of terms, per key."""
    each = rows.select(*key, F.explode(F.array_distinct(terms)).alias("pali")).distinct()
    return each.join(glossary.distinct(), "pali").select(*key, *glossary.columns)


def gram_overlap(rows: DataFrame, text: str, glossary: DataFrame, key: list[str], most: int = 5) -> DataFrame:
    """The glossary's entries whose head is a run of 1 to `most` pieces of a text, per key.

    Runs are made only where a head's first piece stands.
    """
    heads = glossary.distinct()
    first = heads.select(F.element_at(F.split("pali", " "), 1).alias("_piece")).distinct()
    starts = rows.select(*key, gram_pieces(F.col(text)).alias("_pieces")).select(*key, "_pieces", F.posexplode("_pieces").alias("_at", "_piece"))
    starts = starts.select(*key, "_piece", F.slice("_pieces", F.col("_at") + 1, most).alias("_run")).join(first, "_piece", "left_semi")
    runs = F.transform(F.sequence(F.lit(1), F.size("_run")), lambda n: F.array_join(F.slice("_run", 1, n), " "))
    return starts.select(*key, F.explode(runs).alias("pali")).distinct().join(heads, "pali").select(*key, *glossary.columns)


def gloss_alignment(sentences: DataFrame, glosses: DataFrame, more: list[str] | None = None) -> DataFrame:
    """Each line with its gloss as one text, (none) without; of several for a line, that of the last channel."""
    last = glosses.groupBy(*LINE).agg(F.max_by("content", F.struct("channel_id", "content")).alias("content"))
    return sentences.join(last, LINE, "left").select(*LINE, *(more or []), gloss_format(F.col("content")).alias("gloss"))


def linked_targets(src: DataFrame, links: DataFrame) -> DataFrame:
    """(… group columns, dst_book, dst_para, dst_line): what the lines of a group link to, once each."""
    group = [c for c in src.columns if c not in LINE]
    on = [src[a] == links[b] for a, b in zip(LINE, ("src_book", "src_para", "src_line"), strict=True)]
    return src.join(links, on).select(*(src[c] for c in group), "dst_book", "dst_para", "dst_line").distinct()


def line_text(pali: Column, line_id: Column) -> Column:
    return F.concat(F.lit("  ["), line_id, F.lit("] "), F.coalesce(pali, F.lit("")))


def rendered(lines: DataFrame, label: Column, group: list[str]) -> DataFrame:
    """A group's lines as one text: the label, then for each paragraph its name and its lines."""
    paras = lines.groupBy(*group, "book_id", "para_id").agg(
        joined(line_text(F.col("pali"), F.col("line_id")), F.col("line_id")).alias("t"), F.first(label).alias("label")
    )
    head = F.concat(F.lit("\n["), F.col("book_id"), F.lit(" §"), F.col("para_id"), F.lit("]\n"), F.col("t"))
    body = paras.groupBy(*group).agg(joined(head, F.struct("book_id", "para_id")).alias("body"), F.first("label").alias("label"))
    return body.select(*group, F.concat("label", F.lit("\n"), "body").alias("text"))


def rendered_length(paras: DataFrame, label: str, group: list[str]) -> DataFrame:
    """How long rendered() makes a group's text. paras: group, book_id, para_id, and `n` and `chars`: its lines and their characters."""
    head = F.length(F.concat(F.lit("\n["), F.col("book_id"), F.lit(" §"), F.col("para_id"), F.lit("]\n")))
    # line ends between the lines of a paragraph, between paragraphs and after the label
    return paras.groupBy(*group).agg((F.sum(head + F.col("chars") + F.col("n")) + len(label)).alias("length"))


def target_lines(targets: DataFrame, group: list[str], around: int) -> DataFrame:
    """The lines from `around` before each target to as many after, once each."""
    near = F.explode(F.array(*(F.col("dst_line") + d for d in range(-around, around + 1))))
    return targets.select(*group, F.col("dst_book").alias("book_id"), F.col("dst_para").alias("para_id"), near.alias("line_id")).distinct()


def target_paragraphs(targets: DataFrame, group: list[str]) -> DataFrame:
    return targets.select(*group, F.col("dst_book").alias("book_id"), F.col("dst_para").alias("para_id")).distinct()


def commentary(targets: DataFrame, sentences: DataFrame, tier: str) -> DataFrame:
    """The text of a group's targets: their paragraphs (full), three lines around each (window) or they alone (exact)."""
    group = [c for c in targets.columns if not c.startswith("dst_")]
    if tier == "full":
        lines = target_paragraphs(targets, group).join(sentences, ["book_id", "para_id"])
    else:
        lines = target_lines(targets, group, int(tier == "window")).join(sentences, LINE)
    return rendered(lines, F.lit(LABELS[tier]), group)


def commentary_tiered(groups: DataFrame, targets: DataFrame, sentences: DataFrame, most: int) -> DataFrame:
    """For each group the first of the three texts that has at most `most` characters, or else the last; 0: the first.

    The lengths decide first, from sums over the lines; only the text of the tier chosen is then put together.
    """
    key = groups.columns
    chars = F.length(line_text(F.col("pali"), F.col("line_id"))).alias("chars")
    lines = sentences.select(*LINE, "pali", chars)
    sums = F.count("*").alias("n"), F.sum("chars").alias("chars")
    if most <= 0:
        tiers = groups.withColumn("tier", F.lit(1))
    else:
        of_paras = lines.groupBy("book_id", "para_id").agg(*sums)
        full = rendered_length(target_paragraphs(targets, key).join(of_paras, ["book_id", "para_id"]), LABELS["full"], key)
        long = full.filter(F.col("length") > most).select(*key)
        of_lines = target_lines(targets.join(long, key, "left_semi"), key, 1).join(lines, LINE).groupBy(*key, "book_id", "para_id").agg(*sums)
        window = rendered_length(of_lines, LABELS["window"], key)
        # a group that is long has a window, as its targets are lines of the table or near one; without any the window is empty
        third = window.filter(F.col("length") > most).select(*key, F.lit(3).alias("t"))
        second = long.join(third, key, "left").select(*key, F.coalesce("t", F.lit(2)).alias("tier"))
        tiers = groups.join(second, key, "left").withColumn("tier", F.coalesce("tier", F.lit(1)))
    chosen = targets.join(tiers, key)
    by_line = target_lines(chosen.filter("tier = 2"), key, 1).unionByName(target_lines(chosen.filter("tier = 3"), key, 0)).join(lines, LINE)
    by_para = target_paragraphs(chosen.filter("tier = 1"), key).join(lines, ["book_id", "para_id"])
    found = by_para.select(*key, *LINE, "pali").unionByName(by_line.select(*key, *LINE, "pali")).join(tiers, key)
    label = F.element_at(F.array(*(F.lit(x) for x in LABELS.values())), F.col("tier"))
    texts = rendered(found, label, key)
    return tiers.join(texts, key, "left").select(*key, F.coalesce("text", F.lit(NO_COMMENTARY)).alias("commentary"), F.col("tier").cast("int").alias("tier"))


def definition_lookup(rows: DataFrame, key: list[str], text: str, definitions: DataFrame, sentences: DataFrame, most: int = 30) -> DataFrame:
    """For the first `most` long words of each text that a definition has: the word, its stem and the lines around the definition.

    definitions: (word, plain, stem, book_id, para_id, line_id). A word is looked up in word and plain by two
    equality joins; of several stems the least counts, and of a stem's places the first.
    """
    words = rows.select(*key, F.posexplode(F.slice(long_words(F.col(text)), 1, most)).alias("pos", "w"))
    by_word = definitions.select(F.col("word").alias("w"), "stem").unionByName(definitions.select(F.col("plain").alias("w"), "stem"))
    stem = by_word.filter("w is not null").groupBy("w").agg(F.min("stem").alias("stem"))
    place = definitions.groupBy("stem").agg(F.min(F.struct(*LINE)).alias("p")).select("stem", "p.*")
    used = words.select("w").distinct().join(stem, "w").join(place, "stem")
    near = used.select("w", "stem", "book_id", "para_id", F.explode(F.array(*(F.col("line_id") + d for d in (-1, 0, 1)))).alias("line_id"))
    usage = near.join(sentences.select(*LINE, "pali"), LINE).groupBy("w", "stem").agg(joined(F.coalesce("pali", F.lit("")), F.col("line_id"), " … ").alias("usage"))
    return words.join(usage, "w").select(*key, F.col("pos").cast("long").alias("pos"), F.col("w").alias("word"), "stem", "usage")


def infer_para(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Answers (chunk, line_id, para_id) without a paragraph take the first one of their chunk that has the line."""
    first = lines.groupBy("chunk", "line_id").agg(F.min_by("para_id", "pos").alias("first_para"))
    return items.join(first, ["chunk", "line_id"], "left").withColumn("para_id", F.coalesce("para_id", "first_para")).drop("first_para")


def running_totals(rows: DataFrame, group: str, order: list[str], column: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("running", F.sum(column).over(w))


def sampled_context(headings: DataFrame, sentences: DataFrame, references: DataFrame, glosses: DataFrame, most_sentences: int, n: int | None = None, seed: int = 1) -> DataFrame:
    """For headings with an sc_id and pending lines: their first `most_sentences` pending lines, glossed, and the reference's texts.

    n headings are drawn by a hash of their key and a seed; None takes all.
    """
    heads = headings.filter(F.col("sc_id").isNotNull() & (F.col("sc_id") != ""))
    lines = chapter_paragraphs(heads).join(pending_sentences(sentences), ["book_id", "para_id"])
    nth = F.row_number().over(Window.partitionBy("book_id", "head_id").orderBy("para_id", "line_id"))
    lines = lines.withColumn("nth", nth).filter(F.col("nth") <= most_sentences)
    if n is not None:
        drawn = lines.select("book_id", "head_id").distinct().orderBy(F.xxhash64(F.lit(seed), "book_id", "head_id"), "book_id", "head_id").limit(n)
        lines = lines.join(drawn, ["book_id", "head_id"], "left_semi")
    glossed = gloss_alignment(lines.select("head_id", *LINE, "pali", "nth"), glosses, ["head_id", "pali", "nth"])
    item = F.concat(F.lit("["), "para_id", F.lit("/"), "line_id", F.lit("] "), F.coalesce("pali", F.lit("")), F.lit(" = "), "gloss")
    per = glossed.groupBy("book_id", "head_id").agg(F.count("*").alias("n_sentences"), joined(item, F.col("nth")).alias("block"))
    keys = heads.select("book_id", F.col("para_id").alias("head_id"), "sc_id")
    return reference_lookup(per.join(keys, ["book_id", "head_id"]), references)
