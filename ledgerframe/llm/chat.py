"""Conversations in reply order, with quotations linked to their originals and removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep
from .components import components

# turns of a conversation that one task numbers together
BLOCK_TURNS = 1024
# words of a passage that are looked up together
PASSAGE_WORDS = 5
FORMAT = ("<|", "|>\n", "<|end|>\n")
KEYS = ("c", "t", "h")
# they mark passages and their levels while a message is parsed
BEGIN, LEVEL = "\x02", "\x03"


def _normal(line: Column) -> Column:
    """A line as it is compared: lower case, single blanks, none around."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x02\x03\x20\x09-\x0D]+", " "))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, " ", -1), "")


def _hashed_runs(words: Column) -> Column:
    """Hashes of all runs of five words, or of all words if they are fewer; none of none."""
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - (PASSAGE_WORDS - 1), F.lit(1))))
    runs = F.transform(starts, lambda at: F.xxhash64(F.array_join(F.slice(words, at, PASSAGE_WORDS), " ")))
    return F.coalesce(runs, F.array().cast("array<bigint>"))


def parse(conversations: DataFrame) -> DataFrame:
    """One row per distinct message: keys ``c``, ``t``, ``h``, its columns, ``own`` text,
    ``quotes`` (level and hash of each piece it quotes) and ``n_quoted`` lines.

    A line's quote level is the number of ``>`` in front of it; neighbouring lines of one
    level are a passage. A piece is a run of five words, wherever its lines break, so that
    a passage may be wrapped anew or be a part of what it quotes. A passage of fewer words
    is one piece and is found in messages and lines that consist of it. Rows that repeat
    conversation, turn, role and text are one message. NULLs: a text is empty, a turn comes
    first, conversations without an id are one conversation.
    """
    body = F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", body.alias("text")).distinct()
    # no groups that repeat: a line may begin with any number of marks
    marks = lambda line: F.regexp_extract(line, r"^[\x20\t>]*", 0)
    level = lambda line: F.length(F.regexp_replace(marks(line), "[^>]", ""))
    said = lambda line: _normal(F.regexp_replace(line, r"^[\x20\t>]*>\x20?", ""))
    lines = F.split("text", "\n", -1)
    rows = rows.withColumn("lines", F.transform(lines, lambda line: F.struct(level(line).alias("level"), line.alias("line"))))
    rows = rows.withColumn("said", F.transform("lines", lambda x: F.when(x["level"] > 0, said(x["line"])).otherwise(F.lit(""))))
    # marks stand where the level changes; a split at them gives the passages
    marked = F.array_join(F.transform("lines", lambda x, i: F.concat(
        F.when((i > 0) & (F.get("lines", i - 1)["level"] == x["level"]), F.lit(" "))
        .otherwise(F.concat(F.lit(BEGIN), x["level"].cast("string"), F.lit(LEVEL))),
        F.get("said", i),
    )), "")
    passages = F.filter(
        F.transform(F.split(marked, BEGIN, -1), lambda p: F.struct(
            F.substring_index(p, LEVEL, 1).try_cast("int").alias("level"), _words(F.substring_index(p, LEVEL, -1)).alias("words")
        )),
        lambda p: p["level"] > 0,
    )
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    rows = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("c"),
        F.coalesce("turn", F.lit(-(1 << 63))).alias("t"),
        F.md5(F.concat(F.coalesce("role", F.lit("")), F.lit("\x01"), "text")).alias("h"),
        "conv_id", "turn", "role",
        F.trim(F.btrim(own, F.lit("\n"))).alias("own"),
        F.size(F.filter("said", lambda s: s != "")).cast("long").alias("n_quoted"),
        passages.alias("passages"),
    )
    quoted = F.transform("passages", lambda p: F.transform(
        _hashed_runs(p["words"]), lambda hash: F.struct(p["level"].alias("level"), hash.alias("hash"))
    ))
    return rows.select(*KEYS, "conv_id", "turn", "role", "own", "n_quoted", F.flatten(quoted).alias("quotes"))


def _pieces(rows: DataFrame) -> DataFrame:
    """``rows`` with the distinct hashed ``pieces`` of ``own``: its runs of five words, and
    its lines of fewer words."""
    lines = F.transform(F.split("own", "\n", -1), _normal)
    short = F.filter(lines, lambda s: (s != "") & (F.size(F.split(s, " ")) < PASSAGE_WORDS))
    rows = rows.withColumn("words", _words(_normal(F.col("own"))))
    pieces = F.concat(_hashed_runs(F.col("words")), F.transform(short, lambda s: F.xxhash64(s)))
    return rows.withColumn("pieces", F.array_distinct(pieces)).drop("words")


def _numbered(rows: DataFrame, group: list[str], name: str) -> DataFrame:
    """``rows`` with a number from 0 in each group, by ``t`` and ``h``: numbers among the
    messages of one turn whose hashes start alike, what blocks of turns hold before these,
    and what the blocks before hold. No task sees a whole group, or a whole turn."""
    rows = rows.withColumn("block", F.floor(F.col("t") / BLOCK_TURNS)).withColumn("start", F.substring("h", 1, 2))
    inner = Window.partitionBy(*group, "t", "start").orderBy("h")
    sizes = rows.groupBy(*group, "block", "t", "start").agg(F.count(F.lit(1)).alias("size"))
    near = Window.partitionBy(*group, "block").orderBy("t", "start").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy(*group, "block").agg(F.sum("size").alias("size"))
    blocks = blocks.select(*group, "block", F.coalesce(F.sum("size").over(far), F.lit(0)).alias("before"))
    parts = sizes.withColumn("base", F.coalesce(F.sum("size").over(near), F.lit(0))).join(blocks, [*group, "block"])
    bases = parts.select(*group, "t", "start", (F.col("base") + F.col("before")).alias("base"))
    own = rows.drop("block").withColumn("nth", F.row_number().over(inner) - 1)
    joined = own.join(bases, [*group, "t", "start"])
    return joined.withColumn(name, F.col("nth") + F.col("base")).drop("nth", "base", "start")


def quote_links(parsed: DataFrame, messages: DataFrame) -> DataFrame:
    """``(c, n, parent)``: the message that a message quotes, by number.

    Each piece of a quoted passage is looked up among the pieces of earlier messages; the
    latest one that said it counts. Of the levels that find anything the outermost decides,
    then the number of pieces, then the later message. Piece by piece that is an as-of
    match, not a join of all equal pieces: within blocks of messages by a window, from
    block to block by the block's last one, so a piece that everybody says meets nowhere in
    full. Of conversations without a quote nothing is looked up.
    """
    numbers = messages.select(*KEYS, "n")
    with_quotes = parsed.filter(F.size("quotes") > 0)
    quotes = with_quotes.select(*KEYS, "quotes").join(numbers, list(KEYS)).select("c", "n", F.explode("quotes").alias("q"))
    quotes = keep(quotes.select("c", "n", F.col("q.level").alias("level"), F.col("q.hash").alias("hash")))
    asked = quotes.select("c", "hash").distinct()
    # texts are read, cut and hashed in conversations with a quote only
    quoting = keep(with_quotes.select("c").distinct())
    texts = parsed.select(*KEYS, "own").join(quoting, "c", "left_semi").join(numbers, list(KEYS))
    # the outer form: a filter inferred from the inner one would cut texts once per word
    said = _pieces(texts).select("c", "n", F.explode_outer("pieces").alias("hash")).join(asked, ["c", "hash"], "left_semi")
    none = F.lit(None)
    both = keep(
        quotes.select("c", "hash", "n", "level", none.cast("long").alias("found"))
        .unionAll(said.select("c", "hash", "n", none.cast("int").alias("level"), F.col("n").alias("found")))
        .withColumn("block", F.floor(F.col("n") / BLOCK_TURNS))
    )
    group = ["c", "hash"]
    lasts = both.groupBy(*group, "block").agg(F.max("found").alias("last"))
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    lasts = lasts.select(*group, "block", F.max("last").over(before).alias("carried"))
    # strictly earlier messages only
    inner = Window.partitionBy(*group, "block").orderBy("n").rangeBetween(Window.unboundedPreceding, -1)
    matched = (
        both.withColumn("near", F.max("found").over(inner)).filter("level IS NOT NULL")
        .join(lasts, [*group, "block"])
        .withColumn("parent", F.coalesce("near", "carried"))
        .filter("parent IS NOT NULL")
    )
    counted = matched.groupBy("c", "n", "level", "parent").agg(F.count(F.lit(1)).alias("hits"))
    best = F.max(F.struct((-F.col("level")).alias("level"), "hits", "parent")).alias("b")
    return counted.groupBy("c", "n").agg(best).select("c", "n", F.col("b.parent").alias("parent"))


def reply_threads(messages: DataFrame, links: DataFrame) -> DataFrame:
    """``(c, n, parent, thread)`` for the messages of conversations that branch.

    A message without a link answers the one before it. The first answer to a message goes
    on in its thread, any other starts one; a thread is named after its first message.
    """
    apart = links.filter(F.col("parent") < F.col("n") - 1).select("c").distinct()
    # written tables: the loop below reads them again and again
    rows = messages.select("c", "n").join(apart, "c", "left_semi").join(links, ["c", "n"], "left")
    rows = keep(rows.withColumn("parent", F.coalesce("parent", F.when(F.col("n") > 0, F.col("n") - 1))))
    first = rows.filter("parent IS NOT NULL").groupBy("c", "parent").agg(F.min("n").alias("n"))
    name = lambda n: F.xxhash64("c", n)
    chained = components(first.select(name("n").alias("a"), name("parent").alias("b")))
    named = rows.withColumn("node", name("n")).join(chained, "node", "left")
    named = keep(named.withColumn("root", F.coalesce("root", "node")))
    heads = keep(named.groupBy("c", "root").agg(F.min("n").alias("thread")))
    return named.join(heads, ["c", "root"]).select("c", "n", "parent", "thread")


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per distinct message: conv_id, turn, role, reply_to, thread, position,
    n_quoted, text, formatted.

    ``text`` is the message without its quoted lines, ``n_quoted`` how many of these are not
    blank, ``formatted`` the same between role
    and end marks. Sorted by conv_id, thread and position the rows are the conversations in
    reply order: ``thread`` numbers a thread by the place of its first message in the
    conversation, ``position`` counts from 0 within it, and ``reply_to`` is the turn of the
    message that is answered, NULL for a first one. A conversation of any size stays rows;
    it is never gathered. See ``parse`` for repeated rows and NULLs; a NULL role is user.
    """
    parsed = keep(parse(conversations))
    messages = keep(_numbered(parsed.select(*KEYS, "turn"), ["c"], "n"))
    links = keep(quote_links(parsed, messages))
    threads = keep(reply_threads(messages, links))
    # messages of conversations that branch nowhere are one thread
    placed = messages.select(*KEYS, "n").join(threads, ["c", "n"], "left").select(
        *KEYS, "n",
        F.coalesce("parent", F.when(F.col("n") > 0, F.col("n") - 1)).alias("parent"),
        F.coalesce("thread", F.lit(0)).alias("thread"),
    )
    placed = keep(_numbered(placed, ["c", "thread"], "position"))
    turns = messages.select("c", F.col("n").alias("parent"), F.col("turn").alias("reply_to"))
    answered = placed.join(turns, ["c", "parent"], "left")
    role = F.coalesce("role", F.lit("user"))
    return parsed.join(answered, list(KEYS)).select(
        "conv_id", "turn", "role", "reply_to", "thread", "position",
        "n_quoted", F.col("own").alias("text"),
        F.concat(F.lit(FORMAT[0]), role, F.lit(FORMAT[1]), "own", F.lit(FORMAT[2])).alias("formatted"),
    )
