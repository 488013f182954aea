"""Line dedup with a log-template tree, in DataFrame operations only.

Lines are parsed as log lines are: a token with a digit is a variable
field (in scripts written without spaces the run with the digit is); lines
with few words beside their fields are compared as they are.  A line
descends a tree of fixed depth by its number of tokens and
its first ``DEPTH`` tokens to a leaf.  In a leaf that several different
lines reach, the most frequent token of every position makes the leaf's
template, and the lines that agree with it in at least ``SIMILAR`` of the
positions are its lines.  A leaf may hold more templates: tokens that fewer
than ``t`` documents have in their position become fields, and lines that are
equal then have a template if ``SIMILAR`` of its positions are no fields;
``t`` is ``min_docs`` times 1, 4, 16 and so on, so that a frequent value is a
field as well where its template is more frequent.  What has no template yet
is looked at again without the lines that have one, in the leaves that lost
some, until none is found.  Short lines may differ in one position.  Lines
whose template occurs in at least ``min_docs`` documents are dropped, and
with ``long_docs`` also lines of at least ``LONG`` words that are equal but
for their fields in that many documents.

Counting is combined before each shuffle (equal lines meet as one row a
partition); only leaves that several documents reach with different lines
have their tokens looked at.  A text is put together again from the
positions that it loses; texts that lose none stay where they are read.

Defined cases: null texts stay null and have no lines; blank lines are
always kept; a line that repeats in one document counts once; rows that repeat id and text are one document; an empty text
has one blank line.  What recurs is dropped wherever it occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_KEYS, materialise, small

DEPTH = 3
SIMILAR = 0.7
MIN_DOCS = 3
MIN_TOKENS = 8   # shorter lines take no part in the vote and have to agree in more
SHORT_TOKENS = 5     # of four tokens the path alone would make most of the agreement
SHORT_SIMILAR = 0.8  # one position of 5 to 7
STEP = 4             # from one support of tokens to the next one
FIELD = "<*>"
LONG = 50        # words of a long line
LONG_DOCS = 2    # documents that a long line recurs in, where that is asked for
WORDS = 0.4      # least share of words among the words and fields of a line that is masked
# South East Asian scripts, kana, Han and their punctuation
UNSPACED = r"\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3000-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF00-\uFF0F\uFF1A-\uFF20\x{20000}-\x{3FFFF}"


def _even(line: Column) -> Column:
    odd = line.contains("  ")
    for blank in "\t\x0b\f\r":
        odd = odd | line.contains(blank)
    return F.trim(F.when(odd, F.regexp_replace(line, r"\s+", " ")).otherwise(line))


def _spaced(line: Column) -> Column:
    """Whether a line has no character from the Thai block on, so none of
    ``UNSPACED``: simpler patterns say the same of it."""
    return ~line.rlike(r"[\u0E00-\uFFFF\x{10000}-\x{10FFFF}]")


def _masked(line: Column) -> Column:
    """The line with variable fields replaced and white space evened out.
    The patterns start where a token or run does and never go back."""
    field = rf"(?<![^\s{UNSPACED}])[^\s0-9{UNSPACED}]*+[0-9][^\s{UNSPACED}]*+"
    fields = (F.when(_spaced(line), F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*+", FIELD))
               .otherwise(F.regexp_replace(line, field, FIELD)))
    return _even(F.when(line.rlike("[0-9]"), fields).otherwise(line))


def _literal(masked: Column) -> Column:
    """Whether a line has too few words beside its fields: number tables,
    lone years and ids.  Two characters of an unspaced script are a word."""
    fields = F.regexp_count(masked, F.lit(r"<\*>"))
    words = (F.when(_spaced(masked), F.regexp_count(masked, F.lit(r"\p{L}\S*+")))
              .otherwise(F.regexp_count(masked, F.lit(rf"[{UNSPACED}]{{1,2}}|\p{{L}}[^\s{UNSPACED}]*+"))))
    return masked.contains(FIELD) & (words < WORDS * (words + fields))


def _count(items: Column) -> Column:
    return F.when(items.isNull(), 0).otherwise(F.size(items)).cast("long")


def _long(line: Column, size: Column) -> Column:
    """Two characters of an unspaced script are a word; each has two bytes
    more than an ASCII character at least, so most lines need no counting."""
    missing = LONG - size
    return (missing <= 0) | ((F.octet_length(line) - F.length(line) >= 4 * missing)
                             & (F.regexp_count(line, F.lit(rf"[{UNSPACED}]{{2}}")) >= missing))


def _hashes(first: str, second: str, *columns: str) -> list[Column]:
    """Two hashes that do not follow from each other."""
    return [F.xxhash64(*columns).alias(first), F.xxhash64(F.lit(1), *columns).alias(second)]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each line that is not blank: the document's key (two
    hashes of id and text), the position, the masked line, its leaf."""
    key = _hashes("k1", "k2", id_col, text_col)
    # the text is hashed once, before its lines are taken apart
    each = docs.select(*key, F.split(F.col(text_col), "\n").alias("parts")).select(
        "k1", "k2", F.posexplode("parts").alias("pos", "line"))
    masked = each.where(F.col("line").rlike(r"\S")).withColumn("masked", _masked(F.col("line")))
    known = masked.withColumn("literal", _literal(F.col("masked")))
    known = known.withColumn("line", F.when(F.col("literal"), _even(F.col("line"))).otherwise(F.col("masked")))
    size = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    known = known.select("k1", "k2", "pos", "line", "literal", size.alias("size"))
    return known.select("k1", "k2", "pos", *_hashes("a", "b", "line"),
                        # a line compared as it is takes no part in templates
                        F.when(F.col("literal"), 0).otherwise(F.col("size")).alias("n"),
                        _long(F.col("line"), F.col("size")).alias("long"),
                        F.xxhash64("size", F.substring_index("line", " ", DEPTH)).alias("leaf"))


def _tokens(docs: DataFrame, lines: DataFrame, wide: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The lines of the leaves ``wide`` with their tokens and ``w``, how
    often they occur.  One occurrence of each is cut from its document."""
    key = _hashes("k1", "k2", id_col, text_col)
    once = (lines.where(F.col("n") >= SHORT_TOKENS).join(wide, "leaf", "left_semi").groupBy("leaf", "a", "b", "n")
                 .agg(F.count("*").alias("w"), F.min(F.struct("k1", "k2", "pos")).alias("at")))
    once = materialise(once, "lines-once")
    need = once.groupBy("at.k1", "at.k2").agg(F.collect_list(F.struct("at.pos", "leaf", "a", "b", "n", "w")).alias("need"))
    need = materialise(need, "lines-need")
    texts = docs.select(*key, F.col(text_col).alias("text"))
    texts = texts.join(small(need.select("k1", "k2"), BROADCAST_KEYS), ["k1", "k2"], "left_semi").join(need, ["k1", "k2"])
    # an array of one, so that a text is split once
    cut = texts.select(F.explode(F.flatten(F.transform(F.array(F.split("text", "\n")), lambda parts: F.transform(
        "need", lambda x: F.struct(x.alias("x"), F.get(parts, x["pos"]).alias("line")))))).alias("r"))
    # rows that repeat id and text are one document
    return cut.select("r.x.*", "r.line").groupBy("leaf", "a", "b", "n", "w").agg(F.first("line").alias("line")).select(
        "leaf", "a", "b", "n", "w", F.split(_masked(F.col("line")), " ").alias("tokens"))


def _same(x: str, y: str) -> Column:
    """In how many positions two arrays of tokens agree."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda acc, p: acc + p)


def _similar(n: Column) -> Column:
    """How many positions of ``n`` have to agree."""
    return F.when(n < MIN_TOKENS, F.ceil(SHORT_SIMILAR * n - 1e-9)).otherwise(F.ceil(SIMILAR * n - 1e-9)).cast("int")


def _templates(docs: DataFrame, lines: DataFrame, counted: DataFrame, id_col: str, text_col: str,
               min_docs: int) -> DataFrame:
    """(a, b) of the lines that a template generalises, where enough
    documents have one of them."""
    wide = (counted.where(F.col("n") >= SHORT_TOKENS).groupBy("leaf")
                   .agg(F.count("*").alias("lines"), F.sum("docs").alias("docs"))
                   .where((F.col("lines") > 1) & (F.col("docs") >= min_docs)).select("leaf"))
    wide = materialise(wide, "lines-leaves")
    rest = _tokens(docs, lines, wide, id_col, text_col).join(counted.select("a", "b", "docs"), ["a", "b"])
    rest, out = materialise(rest, "lines-tokens"), None
    while True:
        found = _voted(lines, rest.where(F.col("n") >= MIN_TOKENS), min_docs).union(_patterned(lines, rest, min_docs))
        found = materialise(found.distinct(), "lines-found")
        out = found if out is None else out.union(found)
        if found.isEmpty():
            return out
        here = rest.join(small(found, BROADCAST_KEYS), ["a", "b"], "left_semi").select("leaf").distinct()
        rest = rest.join(small(found, BROADCAST_KEYS), ["a", "b"], "left_anti").join(here, "leaf", "left_semi")
        rest = materialise(rest, "lines-rest")


def _voted(lines: DataFrame, held: DataFrame, min_docs: int) -> DataFrame:
    """The lines that agree with the most frequent tokens of their leaf."""
    votes = (held.select("leaf", "w", F.posexplode("tokens").alias("pos", "token"))
                 .groupBy("leaf", "pos", "token").agg(F.sum("w").alias("w"))
                 .groupBy("leaf", "pos").agg(F.max(F.struct("w", "token")).alias("top")))
    # one entry a position: as long as a line
    shape = votes.groupBy("leaf").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", F.col("top.token").alias("token")))),
        lambda x: x["token"]).alias("template"))
    like = held.join(shape, "leaf").where(_same("tokens", "template") >= SIMILAR * F.size("tokens")).select("leaf", "a", "b")
    like = materialise(like, "lines-like")
    often = (lines.join(like.select("a", "b"), ["a", "b"], "left_semi").groupBy("leaf", "k1", "k2").agg(F.lit(1))
                  .groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf"))
    return like.join(often, "leaf").select("a", "b")


def _patterned(lines: DataFrame, held: DataFrame, min_docs: int) -> DataFrame:
    """The lines that are equal to others but for tokens of little support,
    in enough documents together."""
    each = held.select("leaf", "a", "b", "n", "docs", F.posexplode("tokens").alias("pos", "token"))
    support = each.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("s"))
    marked = (each.join(support, ["leaf", "pos", "token"]).groupBy("leaf", "a", "b", "n", "docs")
                  .agg(F.array_sort(F.collect_list(F.struct("pos", "token", "s"))).alias("t")))
    # supports that this line's tokens tell apart
    top = F.array_max(F.transform("t", lambda x: x["s"]))
    steps = F.floor(F.log(float(STEP), F.greatest(top / min_docs, F.lit(1.0))) + 1e-9).cast("int")
    marked = marked.withColumn("least", F.explode(F.transform(
        F.sequence(F.lit(0), steps), lambda i: F.lit(min_docs) * F.pow(F.lit(float(STEP)), i))))
    fits = F.size(F.filter("t", lambda x: x["s"] >= F.col("least"))) >= _similar(F.col("n"))
    pattern = F.transform("t", lambda x: F.when(x["s"] >= F.col("least"), x["token"]).otherwise(FIELD))
    member = (marked.where(fits).select("leaf", "a", "b", "docs", pattern.alias("p"))
                    .select("leaf", "a", "b", "docs", *_hashes("px", "py", "p")).distinct())
    member = materialise(member, "lines-patterns")
    likely = (member.groupBy("leaf", "px", "py").agg(F.count("*").alias("lines"), F.sum("docs").alias("docs"))
                    .where((F.col("lines") > 1) & (F.col("docs") >= min_docs)).select("leaf", "px", "py"))
    member = materialise(member.join(likely, ["leaf", "px", "py"], "left_semi"), "lines-members")
    often = (lines.select("a", "b", "k1", "k2").join(member, ["a", "b"]).groupBy("leaf", "px", "py", "k1", "k2").agg(F.lit(1))
                  .groupBy("leaf", "px", "py").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs))
    return member.join(often.select("leaf", "px", "py"), ["leaf", "px", "py"], "left_semi").select("a", "b")


def _with_positions(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """``rows`` with the positions that they lose.  While these are few, or
    the rows that lose some are, the other texts are not moved."""
    size = gone.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("_gone")), F.lit(0)).alias("m")).first()
    if size["m"] <= BROADCAST_KEYS:
        return rows.join(F.broadcast(gone), ["k1", "k2"], "left")
    if size["n"] > BROADCAST_KEYS:
        return rows.join(gone, ["k1", "k2"], "left")
    keys = F.broadcast(gone.select("k1", "k2"))
    here = rows.join(keys, ["k1", "k2"], "left_semi").join(gone, ["k1", "k2"])
    return here.unionByName(rows.join(keys, ["k1", "k2"], "left_anti"), allowMissingColumns=True)


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_docs: int = MIN_DOCS, long_docs: int | None = None) -> DataFrame:
    """``docs`` with the text without recurring lines, all other columns
    unchanged, and ``_lines``, ``_dropped`` (numbers of lines) behind them."""
    lines = materialise(_lines(docs, id_col, text_col), "lines-rows")
    counted = materialise(lines.groupBy("leaf", "a", "b", "n", "long", "k1", "k2").agg(F.lit(1))
                               .groupBy("leaf", "a", "b", "n", "long").agg(F.count("*").alias("docs")), "lines-counted")
    least = F.when(F.col("long"), min(min_docs, long_docs or min_docs)).otherwise(min_docs)
    drop = (counted.where(F.col("docs") >= least).select("a", "b")
                   .union(_templates(docs, lines, counted, id_col, text_col, min_docs)).distinct())
    drop = materialise(drop, "lines-drop")
    gone = (lines.join(small(drop, BROADCAST_KEYS), ["a", "b"], "left_semi").groupBy("k1", "k2")
                 .agg(F.sort_array(F.collect_set("pos")).alias("_gone")))
    gone = materialise(gone, "lines-gone")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                       *_hashes("k1", "k2", id_col, text_col))
    rows = _with_positions(rows, gone)
    text = F.col(f"_row.`{text_col}`")
    split = F.split(text, "\n")
    # the dropped positions cut the lines into runs that are kept
    edges = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size(split)))
    runs = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1),
                      lambda x, y: F.slice(split, x + 2, y - x - 1))
    cleaned = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n"))
    return rows.select(*[(cleaned if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in names],
                       _count(split).alias("_lines"), _count(F.col("_gone")).alias("_dropped"))
