"""Line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line per connected group.

A line's words are its runs of letters, marks and digits in lower case, so case, blanks and punctuation do not
count; in scripts without blanks every letter is a word. Lines with equal words are one class, however short.
Two lines are similar if 1 - edits / words of the longer one reaches the similarity, with edits of whole words
at every length; so lines whose words allow no edit are similar only if they are equal.

Candidates are lines with an equal block of their SimHash. Bits of a plain SimHash flip one by one: of a line
in which a tenth of the words change, a block wide enough for large tables survives in few cases. Every block
therefore lets only three words vote, the first in an order of its own among the twelve words that come first by
their hashes and lengths (short words are common); a bit of the block is the majority of their
bits. A block thus stays whole unless one of three words changes, and the number of blocks follows from the similarity: so many that at least
one of them survives in 99 % of the pairs that only just reach it, if blocks broke independently and words were
equally long (README has measured figures). DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .linking import link, shared_bands

SIMILARITY = 0.9
BUCKETS = 1 << 20
FIRST_CODE, CODES = 0x10000, 0xF0000  # code points that stand for words
SAMPLE = 12  # words of a line that may vote
VOTERS = 3  # words that decide a block
BITS = 8  # numbers of 64 bits that stand for a line's words
SURVIVAL = 0.99  # share of pairs at the similarity of which a block survives
# Thai, Lao, Myanmar, Khmer, kana and Han; ranges, as looking up the script of every character is slow
UNSPACED = r"([\u0E01-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3021-\u3029\u3038-\u303B\u3041-\u30FA\u30FC-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}])"
WIDE = r"[\u0E01-\x{10FFFF}]"  # a character from the first of them on; one range is found much faster than all of them


def lines_of(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id``, ``copy`` (hash of the text), ``line_no``, ``h``, ``words`` of the lines that take part."""
    line = F.col("line")
    wide = (F.octet_length(line) > F.length(line)) & F.rlike(line, F.lit(WIDE))
    spaced = F.when(wide, F.regexp_replace(line, UNSPACED, " $1 ")).otherwise(line)
    words = F.array_remove(F.split(spaced, r"[^\p{L}\p{M}\p{N}]+"), "")
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("copy"), F.posexplode_outer(F.split(F.lower("text"), "\n")).alias("line_no", "line"))
    # exploded from one element, as a filter would move below a plain projection and split every line twice
    rows = rows.select("doc_id", "copy", "line_no", F.explode(F.array(words)).alias("words")).where(F.size("words") >= max(min_words, 1))
    return rows.select("doc_id", "copy", "line_no", F.xxhash64("words").alias("h"), "words")


def edits(size: Column, similarity: float) -> Column:
    """Edits that ``size`` words allow."""
    return F.floor(size * (1 - similarity) + 1e-9).cast("int")


def block_count(similarity: float) -> int:
    """Blocks of which one survives in SURVIVAL of the pairs at ``similarity``.

    Replacing a share d of the words leaves (1 - d) / (1 + d) of all words of both lines in common, which is
    the chance that both have the same heaviest word.
    """
    whole = (similarity / (2 - similarity)) ** VOTERS
    return 1 if whole >= SURVIVAL else math.ceil(math.log(1 - SURVIVAL) / math.log(1 - whole) - 1e-9)


def word_marks(words: Column) -> Column:
    """One positive number per word: its hash, shifted by the word's length, so that long words come first."""
    return F.transform(words, lambda w: F.call_function("shiftrightunsigned", F.xxhash64(w), F.least(F.length(w), F.lit(16))))


def word_codes(marks: Column) -> Column:
    """One number per word that stands for it when edits are counted."""
    return F.transform(marks, lambda mark: F.pmod(mark, F.lit(CODES)).cast("int"))


def majority(marks: list[Column]) -> Column:
    """64 bits, each the majority of the bits of three marks."""
    a, b, c = (x.bitwiseXOR(F.shiftleft(x, 21)).bitwiseXOR(F.shiftleft(x, 43)) for x in marks)
    return a.bitwiseAND(b).bitwiseOR(a.bitwiseAND(c)).bitwiseOR(b.bitwiseAND(c))


def keyed_lines(marked: DataFrame, similarity: float) -> DataFrame:
    """Lines with ``size``, ``code`` (their word codes) and ``keys`` (the blocks of their SimHash) in place of ``marks``.

    Lines too short for an edit have neither codes nor blocks. Every block orders the words that may vote by their
    distance (exclusive or) from a point of its own, and the points lie apart, so an edit rarely meets two blocks.
    Blocks come from sorts of small arrays, as Spark interprets functions of single elements one by one.
    """
    # the longer of two lines may have one word more
    size, may_differ = F.size("marks"), edits(F.size("marks") + 1, similarity) > 0
    count = block_count(similarity)
    points = [int((k + 0.5) / count * (1 << 32)) for k in range(count)]
    places = {f"s{i}": F.coalesce(F.get("sample", F.lit(i)).bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(1 << 40)) for i in range(SAMPLE)}
    near = {f"v{k}": F.sort_array(F.array(*[F.col(s).bitwiseXOR(F.lit(p)) for s in places])) for k, p in enumerate(points)}
    voters = {f"v{k}_{i}": F.coalesce(F.get(f"v{k}", F.lit(i)), F.lit(0)) for k in range(count) for i in range(VOTERS)}
    keys = F.array(*[majority([F.col(f"v{k}_{i}") for i in range(VOTERS)]) for k in range(count)])
    base = ["doc_id", "copy", "line_no", "h", "size"]
    lines = marked.select(*base[:-1], size.alias("size"), "marks", may_differ.alias("open"), F.slice(F.sort_array(F.array_distinct("marks")), 1, SAMPLE).alias("sample"))
    lines = lines.withColumns(places)
    # the codes are interpreted, which keeps this step out of one large method that the JVM would not compile
    lines = lines.select(*base, "open", F.when(F.col("open"), word_codes(F.col("marks"))).alias("code"), *[v.alias(k) for k, v in near.items()])
    lines = lines.withColumns(voters)
    return lines.select(*base, "code", F.when(F.col("open"), keys).otherwise(F.array().cast("array<long>")).alias("keys"))


def code_text(codes: Column) -> Column:
    """One character per word, so that edit distance counts words."""
    char = lambda code: F.lpad(F.hex(code + FIRST_CODE), 8, "0")
    return F.decode(F.unhex(F.array_join(F.transform(codes, char), "")), "UTF-32")


def similar(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose word codes ``x`` and ``y`` are similar."""
    texts = pairs.withColumn("edits", edits(F.greatest(F.length("x"), F.length("y")), similarity))
    return texts.where(F.expr("levenshtein(x, y, edits)") >= 0).select("a", "b")


def may_be_similar(size: str, mark: str, other_size: str, other_mark: str, similarity: float) -> Column:
    """Can two lines be similar whose first common words are those at ``mark`` and ``other_mark``? Only what follows can be shared too."""
    longer = F.greatest(size, other_size)
    return F.least(F.col(size) - F.col(mark), F.col(other_size) - F.col(other_mark)) + 1 >= longer - edits(longer, similarity)


def may_have_words(similarity: float) -> Column:
    """Can two lines be similar that differ in so many of their ``bits``? An edit changes two words at most, a surplus word is one edit."""
    size, other = F.col("size"), F.col("other_size")
    differ = sum((F.bit_count(F.col(f"bits{i}").bitwiseXOR(F.col(f"other_bits{i}"))) for i in range(BITS)), F.lit(0))
    return differ <= 2 * edits(F.greatest(size, other), similarity) - F.abs(size - other)


def prefix_bands(members: DataFrame, codes: DataFrame, similarity: float) -> DataFrame:
    """``members`` of bands anew, one band for each of a line's rarest words, whose place in the line's order is ``mark``.

    A line's words are ordered by how many of these lines have them, the n-th occurrence of a word being a word of
    its own. Similar lines share all words but the edits, so one of the first edits + 1 words of each is the same
    and no link is lost; lines that share voters, but no rare word, are not compared. Every word flips one of the
    64 * BITS bits of its line (``bits0`` and so on), so lines differ in no more bits than words.
    """
    words = codes.join(members.select("id").distinct(), F.col("h") == F.col("id"), "left_semi").select("h", F.explode(F.split("code", "")).alias("word"))
    times = words.groupBy("h", "word").agg(F.count("*").cast("int").alias("times"))
    words = cut_lineage(times.select(F.col("h").alias("id"), F.explode(F.transform(F.sequence(F.lit(1), F.col("times")), lambda i: F.xxhash64("word", i))).alias("word")))
    common = words.groupBy("word").agg(F.count("*").alias("df"))
    bit = F.expr("shiftleft(1L, cast(word & 63 as int))")
    bits = [F.coalesce(F.bit_xor(F.when(F.pmod(F.shiftright("word", 6), F.lit(BITS)) == i, bit)), F.lit(0).cast("long")).alias(f"bits{i}") for i in range(BITS)]
    ordered = words.join(common, "word").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("words"), *bits)
    first = F.slice("words", 1, edits(F.size("words"), similarity) + 1)
    names = [f"bits{i}" for i in range(BITS)]
    rare = ordered.select("id", F.size("words").alias("size"), *names, F.posexplode(first).alias("place", "w")).where("w.df > 1")
    return cut_lineage(rare.select(F.col("w.word").alias("band"), "id", "size", (F.col("place") + 1).alias("mark"), *names))


def line_groups(docs: DataFrame, min_words: int = 1, similarity: float = SIMILARITY) -> DataFrame:
    """Lines of groups with several: ``doc_id``, ``copy``, ``line_no``, ``group`` and ``first`` (is it the one that stays).

    The first occurrence by (doc_id, copy, line_no) stays.
    """
    if not 0.5 < similarity <= 1:
        raise ValueError("similarity must be over 0.5 and at most 1")
    marked = lines_of(docs, min_words).withColumn("marks", word_marks(F.col("words")))
    # texts are parsed once; lines keep their keys and word codes, never their text
    lines = cut_lineage(keyed_lines(marked, similarity))
    place = F.struct("doc_id", "copy", "line_no")
    classes = cut_lineage(lines.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.first("size").alias("size"), F.first("keys").alias("keys")))
    blocks = classes.select(F.col("h").alias("id"), "size", F.lit(1).alias("mark"), F.posexplode("keys").alias("block", "key"))
    members = shared_bands(blocks.select("id", "size", "mark", F.xxhash64("block", "key").alias("band")))
    near = may_be_similar("size", "mark", "other_size", "other_mark", similarity)
    wanted = cut_lineage(members.select(F.col("id").alias("h")).distinct().join(classes, "h").select("h", "first.*"))
    # at most BUCKETS numbers, so small enough for a broadcast; they spare most other lines the shuffle
    bucket = F.pmod("h", F.lit(BUCKETS)).alias("bucket")
    near_codes = lines.where("code IS NOT NULL").select("doc_id", "copy", "line_no", "h", "code").withColumn("bucket", bucket)
    near_codes = near_codes.join(F.broadcast(wanted.select(bucket).distinct()), "bucket", "left_semi").drop("bucket")
    codes = cut_lineage(near_codes.join(wanted, ["h", "doc_id", "copy", "line_no"], "left_semi").dropDuplicates(["h"]).select("h", code_text(F.col("code")).alias("code")))

    def confirm(pairs: DataFrame) -> DataFrame:
        x = codes.select(F.col("h").alias("a"), F.col("code").alias("x"))
        y = codes.select(F.col("h").alias("b"), F.col("code").alias("y"))
        return similar(pairs.join(x, "a").join(y, "b"), similarity)

    components = link(members, confirm, near, lambda open_members: prefix_bands(open_members, codes, similarity), near & may_have_words(similarity))
    grouped = classes.join(components.withColumnRenamed("id", "h"), "h", "left")
    grouped = cut_lineage(grouped.select("h", F.coalesce("component_id", "h").alias("group"), "n", "first"))
    kept = grouped.groupBy("group").agg(F.sum("n").alias("of"), F.min("first").alias("first"))
    of_class = cut_lineage(grouped.select("h", "group").join(kept.where("of > 1"), "group"))
    return lines.select("doc_id", "copy", "line_no", "h").join(of_class, "h").select("doc_id", "copy", "line_no", "group", (place == F.col("first")).alias("first"))


def dedup_lines(docs: DataFrame, min_words: int = 1, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``_lines``, ``_dropped`` (numbers of lines).

    Lines without a word or with fewer than ``min_words`` always stay, as do lines of documents with a NULL
    id. Texts without a repeated line, NULL and empty ones stay as they are; a document that loses all its
    lines keeps its row with an empty text. Repeated rows are one document, so each keeps the same lines; rows
    of one id with different texts are told apart. Other columns are handed on whatever their names, except
    that ``_lines`` and ``_dropped`` are replaced; an empty table stays empty.
    """
    groups = line_groups(docs, min_words, similarity)
    gone = groups.where(~F.col("first")).groupBy("doc_id", "copy").agg(F.collect_list("line_no").alias("lines"))
    same = (F.col("d.doc_id") == F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.copy"))
    joined = docs.alias("d").join(gone.alias("g"), same, "left")
    old, out = F.col("d.text"), F.col("g.lines")
    lines = F.split(old, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), out)
    text = F.when(out.isNull(), old).otherwise(F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n"))
    dropped = F.when(out.isNull(), 0).otherwise(F.size(out))
    count = F.when(old.isNull(), 0).otherwise(F.size(lines))
    others = [text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns if c not in ("_lines", "_dropped")]
    return joined.select(*others, count.cast("long").alias("_lines"), dropped.cast("long").alias("_dropped"))
