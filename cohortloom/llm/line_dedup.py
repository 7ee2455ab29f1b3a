"""Line dedup: equal lines, and lines one word apart, by a deletion-neighbourhood join.

Two lines are one word apart if one comes from the other by inserting, deleting
or replacing a word. A line's deletion neighbourhood is the line with each of its
words left out in turn. Two lines of equal length are one replacement apart if
their variants with the same word left out are equal; a line and a longer one
are one insertion apart if the shorter equals a variant of the longer. So what a
line needs to know of its neighbours is the earliest of those under each key,
an aggregate, and no pairs of a group are ever made.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.workspace import Workspace

#: Lines of fewer words are only dropped as exact copies, unless the caller sets another least length.
MIN_WORDS = 8
#: What separates words: space and the ASCII controls from tab to carriage return.
_SPACES = " \t\x0b\x0c\r\n"


def _two_hashes(*parts: Column) -> tuple[Column, Column]:
    """128 bits of two independent hashes, as integers that aggregates keep in place."""
    return F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)


#: A place as one number: the id, 31 bits of the line's number, 31 of the hash of the text.
_LINE, _TEXT = 1 << 31, (1 << 31) - 1
#: Keys of a line by its first and its last words, and those of a length below it.
_HALVES = [f"half_{i}" for i in range(4)]


def _text_hash(text: Column) -> Column:
    """What tells texts apart that share an id."""
    return F.xxhash64(text).bitwiseAND(F.lit(_TEXT))


def _text_place(id_col: str, text: Column) -> Column:
    """Id and text as one decimal, with room for the line's number."""
    whole = F.col(id_col).cast("long").cast("decimal(20,0)") * F.lit(_LINE * _LINE).cast("decimal(19,0)")
    return (whole + _text_hash(text)).cast("decimal(38,0)")


def _place() -> Column:
    """Id, line and text as one decimal of the same order, which hash aggregates keep in place."""
    return (F.col("text_place") + F.col("line_no").cast("bigint") * _LINE).cast("decimal(38,0)")


def _with_parts(placed: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line_no`` of the places in ``first``."""
    size = f"CAST({_LINE * _LINE} AS DECIMAL(38,0))"
    inner = placed.select("first", F.expr(f"CAST(pmod(first, {size}) AS BIGINT)").alias("inner"))
    return inner.select(
        F.expr(f"(first - inner) div {size}").alias("doc_id"),
        F.expr(f"inner % {_LINE}L").alias("text_hash"),
        F.expr(f"inner div {_LINE}L").alias("line_no"),
    )


def _is_full(line: Column) -> Column:
    """Trimmed on the left only, which reads no further than the first word."""
    return F.octet_length(F.ltrim(line, F.lit(_SPACES))) > 0


def _spaced(line: Column) -> Column:
    """The words of a line with one space between; most lines are that already."""
    plain = ~reduce(or_, [F.contains(line, F.lit(c)) for c in ("  ", *_SPACES[1:-1])])
    plain &= ~F.startswith(line, F.lit(" ")) & ~F.endswith(line, F.lit(" "))
    return F.when(plain, line).otherwise(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def _word_count(line: Column) -> Column:
    """One more than spaces; counted in bytes, without making an array of words."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def split_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``text_place, line_no, line`` of the lines that are not blank; a null text has none.

    What holds of the text is computed before its lines are dealt out, once per text.
    """
    text = F.col(text_col)
    return (
        docs.select(_text_place(id_col, text).alias("text_place"), text.alias("text"))
        .select("text_place", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .filter(_is_full(F.col("line")))
        .withColumn("line", _spaced(F.col("line")))
    )


def _length_class(n: Column) -> Column:
    """The least of the lengths taken together with ``n``, less than a quarter below it."""
    bits = F.greatest(F.lit(0), F.floor(F.log2(n)).cast("int") - 2)
    return n - n % F.call_function("shiftleft", F.lit(1), bits)


def _length_classes(n: Column) -> dict[str, Column]:
    """``size`` of a line of ``n`` words, and ``below``, of one with a word less."""
    return {"size": _length_class(n), "below": _length_class(n - 1)}


def _half(size: Column) -> Column:
    return F.call_function("shiftright", size, F.lit(1))


def with_half_keys(lines: DataFrame, min_words: int) -> DataFrame:
    """``lines`` with the number ``n`` of words and keys of which two lines one word apart share one.

    Both have at least ``size`` words, the length class of the shorter. If they
    differ after the first half of ``size``, so many first words are equal, else
    so many last words are. The longer one may be the first of the next class,
    so those also take the keys of the class below.
    """
    # Columns of their own: within a condition Spark would compute them once per key.
    n = F.col("n")
    sized = lines.withColumn("n", _word_count(F.col("line"))).withColumns(_length_classes(n))
    keys = []
    for size, holds in (("size", n >= min_words), ("below", (n > min_words) & (F.col("below") != F.col("size")))):
        half = _half(F.col(size))
        keys.append(F.when(holds, F.xxhash64(F.lit(0), size, _ends(F.col("line"), half))))
        keys.append(F.when(holds, F.xxhash64(F.lit(1), size, _ends(F.col("line"), -half))))
    return sized.withColumns(dict(zip(_HALVES, keys)))


def _words_to_leave_out() -> Column:
    """0 and the numbers of the words in which a line can differ from those it shares a half with.

    Who shares the first half of a size differs after it, who shares the last one before.
    """
    shares = lambda i: F.col("shares").bitwiseAND(F.lit(1 << i)) != 0
    size, below = _half(F.col("size")), _half(F.col("below"))
    return F.filter(
        F.sequence(F.lit(0), "n"),
        lambda word: (word == 0)
        | (shares(0) & (word > size))
        | (shares(1) & (word <= size))
        | (shares(2) & (word > below))
        | (shares(3) & (word <= below)),
    )


def _ends(line: Column, words: Column) -> Column:
    """The first words of a line, or the last if ``words`` is negative."""
    return F.call_function("substring_index", line, F.lit(" "), words)


def _near_lines(
    work: Workspace, docs: DataFrame, firsts: DataFrame, id_col: str, text_col: str, min_words: int
) -> DataFrame:
    """``h1, h2`` of the distinct lines that have an earlier line one word apart."""
    keyed = (
        firsts.filter("half_0 IS NOT NULL")
        .select("h1", "h2", F.posexplode(F.array(*_HALVES)).alias("at", "half"))
        .filter("half IS NOT NULL")
    )
    shared = keyed.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    shares = F.bit_or(F.expr("shiftleft(1, at)")).alias("shares")
    likely = work.cut(keyed.join(shared, "half", "left_semi").groupBy("h1", "h2").agg(shares))
    h1, h2 = _two_hashes(F.col("line"))
    own = work.cut(firsts.join(likely, ["h1", "h2"]).select("h1", "h2", "first", "shares"))
    work.forget(likely)
    # Only documents in which such a line comes first are split again.
    wanted = work.cut(_with_parts(own).select(F.col("doc_id").alias("wanted_id")).distinct())
    likely_docs = docs.join(wanted, F.col(id_col).cast("long") == F.col("wanted_id"), "left_semi")
    lines = work.cut(
        split_lines(likely_docs, id_col, text_col)
        .filter(_word_count(F.col("line")) >= min_words)
        .select("line", h1.alias("h1"), h2.alias("h2"), _place().alias("place"))
        .join(own, ["h1", "h2"])
        .filter("place = first")
        .dropDuplicates(["h1", "h2"])
        .select("h1", "h2", "first", "line", "shares", _word_count(F.col("line")).alias("n"))
    )
    v1, v2 = _two_hashes(_without(F.col("line"), F.col("n"), F.col("left_out")))
    variants = work.cut(
        lines.withColumns(_length_classes(F.col("n")))
        .select("*", F.explode(_words_to_leave_out()).alias("left_out"))
        .select("h1", "h2", "first", "left_out", v1.alias("v1"), v2.alias("v2"))
    )
    met = variants.groupBy("v1", "v2").agg(F.count("*").alias("n")).filter("n > 1").select("v1", "v2")
    neighbours = work.cut(variants.join(met, ["v1", "v2"], "left_semi"))
    earliest = F.min(F.struct("first", "h1", "h2")).alias("earliest")
    replaced = neighbours.filter("left_out > 0").groupBy("v1", "v2", "left_out").agg(earliest, F.count("*").alias("n"))
    by_place = (
        neighbours.join(replaced.filter("n > 1").drop("n"), ["v1", "v2", "left_out"])
        .filter(F.col("earliest.first") < F.col("first"))
        .select("h1", "h2", "earliest")
    )
    wholes = neighbours.filter("left_out = 0").select("v1", "v2", F.struct("first", "h1", "h2").alias("earliest"))
    longer = neighbours.filter("left_out > 0").groupBy("v1", "v2").agg(earliest)
    inserted = (
        neighbours.filter("left_out > 0")
        .join(wholes, ["v1", "v2"])
        .filter(F.col("earliest.first") < F.col("first"))
        .select("h1", "h2", "earliest")
    )
    deleted = (
        neighbours.filter("left_out = 0")
        .join(longer, ["v1", "v2"])
        .filter(F.col("earliest.first") < F.col("first"))
        .select("h1", "h2", "earliest")
    )
    found = by_place.unionByName(inserted).unionByName(deleted).groupBy("h1", "h2").agg(F.min("earliest").alias("e"))
    words = F.split("line", " ")
    other = lines.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), words.alias("others"))
    return (
        found.select("h1", "h2", F.col("e.h1").alias("o1"), F.col("e.h2").alias("o2"))
        .join(lines.select("h1", "h2", words.alias("words")), ["h1", "h2"])
        .join(other, ["o1", "o2"])
        .filter(within_one_word(F.col("words"), F.col("others")))
        .select("h1", "h2")
    )


def _without(line: Column, n: Column, word: Column) -> Column:
    """A line of ``n`` words with one left out, counted from 1, or whole for 0."""
    before, after = _ends(line, word - 1), _ends(line, word - n)
    return (
        F.when(word == 0, line)
        .when(word == 1, after)
        .when(word == n, before)
        .otherwise(F.concat(before, F.lit(" "), after))
    )


def within_one_word(x: Column, y: Column) -> Column:
    """Whether at most one word was inserted, deleted or replaced: what both share at either end."""
    shorter, longer = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))
    differs = lambda a, b: F.array_position(F.zip_with(a, b, lambda p, q: ~p.eqNullSafe(q)), True)
    head = differs(x, y)
    tail = differs(F.reverse(x), F.reverse(y))
    return (head == 0) | ((longer - shorter <= 1) & ((head - 1) + (tail - 1) >= longer - 1))


def dedup_lines(
    work: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept_text``.

    Lines are what ``\\n`` parts, words what ASCII white space parts. A line goes if
    an earlier one, by (id, number of the line), has the same words, or, of lines of
    ``min_words`` words or more, is one word apart. Lines are judged on the input, not on
    what is left. Lines without words stay. What stays is joined
    by ``\\n``. A null text has no lines and stays null. Rows that repeat id and
    text are judged alike; of rows that share the id only, equal lines at one
    place stay in one. Rows without an id stay as they are and count for no
    other. Other columns of ``docs`` are not read.

    Lines that cannot be one word apart from any other, as they share no half
    with one, take no part in the deletion join; nothing is lost by that.
    A line that a third of all documents have is one row per task after the
    first aggregation, and one row in all that follows.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    h1, h2 = _two_hashes(F.col("line"))
    firsts = work.cut(
        with_half_keys(split_lines(named, id_col, text_col), min_words)
        .select(h1.alias("h1"), h2.alias("h2"), _place().alias("place"), *_HALVES)
        .groupBy("h1", "h2")
        # Equal lines have equal halves.
        .agg(F.min("place").alias("first"), *[F.max(name).alias(name) for name in _HALVES])
    )
    near = work.cut(_near_lines(work, named, firsts, id_col, text_col, min_words))
    # The lines that stay, as bits: one integer for 64 lines of a text.
    bits = (
        _with_parts(firsts.join(near, ["h1", "h2"], "left_anti"))
        .groupBy("doc_id", "text_hash", F.floor(F.col("line_no") / 64).cast("int").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(line_no % 64 AS INT))")).alias("bits"))
        .groupBy("doc_id", "text_hash")
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "bits"))).alias("by_at"), F.max("at").alias("last"))
        .select(
            "doc_id",
            "text_hash",
            F.transform(F.sequence(F.lit(0), "last"), lambda i: F.coalesce(F.try_element_at("by_at", i), F.lit(0))).alias("bits"),
        )
    )
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text")
    )
    word = lambda i: F.coalesce(F.get("bits", F.floor(i / 64).cast("int")), F.lit(0))
    stays = lambda line, i: (
        F.col("doc_id").isNull() | ~_is_full(line) | (F.getbit(word(i), i % 64) == 1)
    )
    return work.result(
        texts.join(bits, ["doc_id", "text_hash"], "left")
        .withColumn("lines", F.split("text", "\n"))
        .withColumn("kept", F.filter("lines", stays))
        .select(
            "doc_id",
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
            F.array_join("kept", "\n").alias("kept_text"),
        )
    )
