"""Spelling variants by permuterm rotations.

A word ``w`` marked with a terminator has one rotation per character. The rotation that ends in
character ``x`` of ``a x b`` reads ``b $ a x``: its prefix ``b $ a`` skips ``x``. Every word that
differs from ``a x b`` in this character has a rotation with the same prefix and one character
more (a replacement), and the word ``a b`` without it has the rotation ``b $ a`` itself (an
indel). Rotations sorted by that prefix therefore bring all near words together in groups, each
at most one whole rotation and one row per character of the alphabet. A scan of a group
gives every member its number of neighbours and its best one; no pairs are made.

All steps are DataFrame functions. Words are counted before anything is shuffled by word, so a
word that holds a third of all rows is one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalcast.session import cut_lineage, read_table

#: Ends a word; no character of a word.
TERMINATOR = "$"
#: Doubling steps of the chain of forms; ``2 ** 40`` steps are out of reach, since n doubles at each.
MAX_DOUBLINGS = 40


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, word, n, whole, counted)`` of the rotations of ``words`` (word, n; each word
    once). A rotation enters as it is (``whole``) and, unless the terminator ends it, without its
    last character. In a row of equal characters, leaving out any of them gives the same
    shorter word; only the first is ``counted`` as an indel."""
    turned = (words.select("word", "n", F.concat("word", F.lit(TERMINATOR)).alias("m"),
                           F.explode(F.expr("sequence(0, char_length(word))")).alias("i"))
              .withColumn("rotation", F.expr("concat(substring(m, i + 1), substring(m, 1, i))")))
    # rotation i starts with character i and ends with character i - 1
    forms = F.array(F.struct(F.col("rotation").alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("counted")),
                    F.struct(F.expr("left(rotation, char_length(rotation) - 1)").alias("prefix"), F.lit(False).alias("whole"),
                             F.expr("i = 1 or substring(m, i, 1) != substring(m, i - 1, 1)").alias("counted")))
    return (turned.withColumn("f", F.explode(F.when(F.col("i") > 0, forms).otherwise(F.slice(forms, 1, 1))))
            .select("f.prefix", "word", "n", "f.whole", "f.counted"))


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` for every word of ``words`` (word, n) with a near word: the number
    of its near words and the one of largest n, ties to the smallest in code-point order, as
    ``struct<m: -n, word>``. A group has at most one whole rotation, and one other row per
    character of the alphabet."""
    group = Window.partitionBy("prefix")
    scan = group.orderBy("m", "word")
    r = rotations(words).withColumn("m", -F.col("n"))
    r = r.withColumn("k", F.row_number().over(scan))
    r = (r.withColumn("size", F.count(F.lit(1)).over(group))
         .withColumn("cuts", F.count_if(~F.col("whole")).over(group))
         .withColumn("indels", F.count_if("counted").over(group))
         .withColumn("has_whole", F.max("whole").over(group))
         .withColumn("first", F.first(F.struct("m", "word")).over(scan))
         .withColumn("second", F.max(F.when(F.col("k") == 2, F.struct("m", "word"))).over(group))
         .where("size > 1"))
    near = F.when(F.col("whole"), F.col("indels")).otherwise(
        F.col("cuts") - 1 + F.when(F.col("has_whole") & F.col("counted"), 1).otherwise(0))
    best = F.when(F.col("k") == 1, F.col("second")).otherwise(F.col("first"))
    return r.groupBy("word").agg(F.sum(near).alias("n_near"), F.min(best).alias("best")).where("n_near > 0")


def spelling_groups(words: DataFrame, factor: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every row of ``words`` (word, n; other columns
    are ignored). Words are near if they differ by one inserted, deleted or replaced code point.
    ``form`` is the near word of largest n, ties to the smallest in code-point order, if its n is
    at least ``factor`` times that of the word; ``root`` ends the chain of forms. ``factor``
    is 2 or more, so chains end after about log2 of the largest n.

    Defined cases: null words are left out; repeated words count as one with the sum of their n
    (a null n adds none); a word may not hold the terminator ``$`` (refused); a word without
    near words has n_near 0 and is its own root; an empty table gives an empty result."""
    if factor < 2:
        raise ValueError("factor is 2 or more")
    words = cut_lineage(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n"))
                        .where("word is not null").groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "spelling-words")
    if words.where(F.col("word").contains(TERMINATOR)).limit(1).count():
        raise ValueError(f"words must not contain {TERMINATOR}")
    near = neighbours(words)
    far = -F.col("best.m")
    out = (words.join(near, "word", "left")
           .withColumn("form_n", F.when(far >= factor * F.col("n"), far).cast("long"))
           .withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.word")))
           .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n"))
    out = cut_lineage(out, "spelling-forms")
    return out.join(chain_ends(out.where("form is not null").select("word", F.col("form").alias("to"))), "word", "left") \
              .withColumn("root", F.coalesce("root", "word"))


def chain_ends(step: DataFrame) -> DataFrame:
    """``(word, root)`` of the rows ``(word, to)`` of a forest: the end of each chain, by pointer
    doubling (each round halves what is left of all chains)."""
    step = cut_lineage(step, "spelling-chain")
    for _ in range(MAX_DOUBLINGS):
        ahead = step.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = cut_lineage(step.join(ahead, "to", "left").select("word", F.coalesce("further", "to").alias("to"),
                                                                 F.col("further").isNotNull().alias("moved")), "spelling-chain")
        if not step.where("moved").limit(1).count():
            return step.select("word", F.col("to").alias("root"))
        step = step.select("word", "to")
    raise RuntimeError("chains of forms do not end")


def with_typing_errors(docs: DataFrame) -> DataFrame:
    """``(word)``: the runs ``[A-Za-z\\u00C0-\\u00FF]+`` of all texts with A-Z lower-cased; where 97
    divides the crc32 of ``<doc_id>:<run>`` the run loses one code point. A null id reads as an
    empty one there."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.expr("regexp_extract_all(cast(text as string), '[A-Za-z\\u00C0-\\u00FF]+', 0)")).alias("run"))
    # lower() also folds letters beyond ASCII, but is much the faster one where there are none
    runs = runs.withColumn("run", F.expr("if(octet_length(run) = char_length(run), lower(run), translate(run, "
                                         "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"))
    h = runs.withColumn("h", F.expr("crc32(cast(concat(id, ':', run) as binary))"))
    gone = "int(h % char_length(run))"
    return h.select(F.expr(f"if(h % 97 = 0, concat(left(run, {gone}), substring(run, {gone} + 2)), run)").alias("word"))


def count_words(words: DataFrame, least_length: int = 5, least_n: int = 3) -> DataFrame:
    """``(word, n)`` of the words of at least ``least_length`` code points and ``least_n`` rows."""
    return (words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_n))


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    """Variants among the words of 5 code points and 3 occurrences or more of all documents."""
    words = count_words(with_typing_errors(read_table(spark, sf_dir, "documents")))
    return spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op13_spelling_variants": op13_spelling}
