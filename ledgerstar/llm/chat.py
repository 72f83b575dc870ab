"""Chat formatting in budgeted windows.

A conversation becomes one or more training samples. Prefix sums of turn tokens choose spans of whole
turns within the budget; every sample starts with the system turn, repeats a limited number of tokens of
the turns before its span as history, and then holds its own turns. Only assistant texts of its own turns
carry loss; what is repeated is masked, so each assistant text is a target exactly once.

Template, per turn: ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside roles and texts a backslash is put
behind every ``<``, ``[`` and backslash, which breaks up these markers and any other control string that
starts with ``<`` or ``[``, and is undone by dropping it again.

DataFrame expressions only. Turns are numbered by ranges of rows and cut in chunks of at most ``CHUNK`` turns,
so a conversation of any length is dealt over many tasks. What a chunk does to the open span that enters it
is a short table (where its first cut can fall); a fold over the tables of a long conversation carries the
open span from chunk to chunk. Texts meet again one sample at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerstar.llm.common import cut, ident

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"   # the template's fixed markers
BUDGET = 512      # tokens of a sample
HISTORY = 128     # tokens of repeated history in it
TURN_TOKENS = 4   # markers and role of a turn
CHUNK = 1024      # turns of a conversation that are gathered at once
SYSTEM, TARGET = "system", "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])\\", "$1")


def n_tokens(text: Column) -> Column:
    """The token measure: runs of letters and digits, and single other characters that are not white space."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long") + TURN_TOKENS


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per turn, numbered: conv, pos, sys (is the system turn), tok, rendered, head, body, target."""
    role, text = (F.coalesce(ident(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    src = df.select(ident(conv_col).alias("conv"), ident(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    # ranges of rows, written: a row's number is its place in its range and the rows of its conversation in ranges before
    order = ["conv", "turn", "role", "text", "tie"]  # the tie lets equal rows lie in several ranges
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(src.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("range", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
                 .drop("turn", "tie"), "chat-turns")
    parts = placed.groupBy("conv", "range").agg(F.count("*").alias("n"), F.min("place").alias("lo"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("conv").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("conv").alias("c"), F.col("range").alias("r"), (before - F.col("lo") + 1).alias("shift"))
    src = placed.join(parts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    return (src.withColumn("pos", (F.col("place") + F.col("shift")).cast("long")).withColumn("body", escape(F.col("text"))).withColumn("headed", head)
            .select("conv", "pos", ((F.col("pos") == 1) & (F.col("role") == SYSTEM)).alias("sys"), n_tokens(F.col("text")).alias("tok"),
                    F.concat("headed", "body", F.lit(END)).alias("rendered"), F.length("headed").alias("head"),
                    F.length("body").alias("body"), (F.col("role") == TARGET).alias("target")))


def _chunks(turns: DataFrame, history: int, budget: int, chunk: int) -> DataFrame:
    """conv, chunk, long (of a conversation of several chunks), skip, room, back (turns in front that can be its history), t (its turns), without the system turn."""
    reach = history // TURN_TOKENS
    numbers = turns.select("conv", "pos", "sys", "tok")
    places = numbers.withColumn("chunk", F.explode(F.expr(f"sequence((pos - 1) div {chunk}, (pos - 1 + {reach}) div {chunk})")))
    rows = places.groupBy("conv", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "tok", "sys"))).alias("all"))
    rows = rows.filter(f"exists(all, x -> x.pos > chunk * {chunk})")
    # a row per chunk of each conversation of several chunks, with the tokens of its system turn; joined chunk by chunk
    ends = numbers.groupBy("conv").agg(F.max("pos").alias("last"), F.max(F.when(F.col("sys"), F.col("tok"))).alias("head")).filter(F.col("last") > chunk)
    heads = ends.select(F.col("conv").alias("c"), "head", F.explode(F.expr(f"sequence(0L, (last - 1) div {chunk})")).alias("k"))
    rows = rows.join(heads, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left").withColumn("long", F.col("k").isNotNull()).drop("c", "k")
    head = F.coalesce("head", F.expr("if(all[0].sys, all[0].tok, null)"))
    return (rows.withColumn("head", head).withColumn("skip", F.col("head").isNotNull().cast("int"))
            .withColumn("room", F.greatest(F.lit(1), budget - history - F.coalesce("head", F.lit(0))).cast("long"))
            .select("conv", "chunk", "long", "skip", "room", F.expr(f"filter(all, x -> x.pos <= chunk * {chunk} and not x.sys)").alias("back"),
                    F.expr(f"filter(all, x -> x.pos > chunk * {chunk} and not x.sys)").alias("t")))


def _entries(chunks: DataFrame) -> DataFrame:
    """c, k, sum, sample: tokens and number of the open span that enters chunk k, of conversations of several chunks."""
    rows = chunks.filter("long").withColumnRenamed("conv", "c")
    # tokens of the chunk up to each turn that can be its first cut; every turn has TURN_TOKENS at least
    rows = rows.withColumn("upto", F.expr(f"""
        aggregate(slice(t, 1, if(chunk = 0, 1, cast(room div {TURN_TOKENS} + 2 as int))), cast(array() as array<bigint>),
          (a, x) -> if(size(a) > 0 and element_at(a, -1) > room, a, a || array(if(size(a) > 0, element_at(a, -1), 0L) + x.tok)))"""))
    rows = rows.withColumn("first", F.expr("""
        transform(upto, (p, j) -> named_struct('upto', p, 'end', aggregate(slice(t, j + 1, size(t) - j), named_struct('sum', 0L, 'n', 0L),
          (a, x) -> if(a.n = 0 or a.sum + x.tok > room, named_struct('sum', x.tok, 'n', a.n + 1), named_struct('sum', a.sum + x.tok, 'n', a.n)))))"""))
    rows = rows.withColumn("total", F.expr("aggregate(t, 0L, (a, x) -> a + x.tok)"))
    whole = rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("chunk", "total", "first"))).alias("x"), F.first("room").alias("room"))
    # the first chunk opens span 0 with its first turn; a later chunk cuts first where the open span overruns the room
    fold = F.expr("""
        aggregate(x, named_struct('sum', 0L, 'sample', -1L, 'in', cast(array() as array<struct<k:bigint,sum:bigint,sample:bigint>>)),
          (a, y) -> transform(array(get(filter(y.first, f -> a.sample < 0 or a.sum + f.upto > room), 0)), f -> named_struct(
            'sum', if(f is null, a.sum + y.total, f.end.sum), 'sample', if(f is null, a.sample, a.sample + f.end.n),
            'in', a.in || array(named_struct('k', y.chunk, 'sum', a.sum, 'sample', a.sample))))[0], a -> a.in)""")
    return whole.select("c", F.explode(fold).alias("e")).select("c", "e.*").filter("k > 0")


def _spans(turns: DataFrame, budget: int, history: int, chunk: int = CHUNK) -> DataFrame:
    """conv, sample, pos, own: which turns each sample holds, and which of them are its own."""
    reach = history // TURN_TOKENS
    chunks = cut(_chunks(turns, history, budget, chunk), "chat-chunks")
    rows = chunks.join(_entries(chunks), F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left")
    # a span ends before the turn that would overrun the room; cuts are positions
    rows = rows.withColumn("cuts", F.expr("""
        aggregate(t, named_struct('sum', coalesce(sum, 0L), 'open', chunk > 0, 'cuts', cast(array() as array<bigint>)),
          (a, x) -> if(a.open and a.sum + x.tok > room, named_struct('sum', x.tok, 'open', true, 'cuts', a.cuts || array(x.pos)),
                       named_struct('sum', a.sum + x.tok, 'open', true, 'cuts', a.cuts)), a -> a.cuts)"""))
    rows = rows.withColumn("sample", F.coalesce("sample", F.lit(0).cast("long"))).withColumn("edges", F.expr(
        f"array(if(chunk = 0, skip + 1L, chunk * {chunk} + 1L)) || cuts")).withColumn("end", F.expr(f"if(size(t) > 0, element_at(t, -1).pos, skip + 0L)"))
    # the spans that are open in the chunk: the entering one (or the conversation's first), then one per cut; each carries
    # only its own history, the nearest turns before it whose tokens together stay within the limit
    rows = rows.withColumn("near", F.expr("back || t")).withColumn("pieces", F.expr(f"""
        transform(edges, (f, i) -> named_struct('sample', sample + i, 'first', f, 'last', coalesce(get(edges, i + 1) - 1, end), 'starts', i > 0 or chunk = 0,
          'held', if(i = 0, 0L, aggregate(reverse(slice(near, cast(greatest(1, f - near[0].pos + 1 - {reach}) as int), cast(least(f - near[0].pos, {reach}) as int))),
            named_struct('n', 0L, 'sum', 0L, 'open', true),
            (a, x) -> if(a.open and a.sum + x.tok <= {history}, named_struct('n', a.n + 1, 'sum', a.sum + x.tok, 'open', true),
                         named_struct('n', a.n, 'sum', a.sum, 'open', false)), a -> a.n))))"""))
    rows = rows.select("conv", "skip", F.explode("pieces").alias("p")).select("conv", "skip", "p.*")
    place = F.explode(F.expr("""concat(if(skip = 1 and starts, array(named_struct('at', 1L, 'own', sample = 0)), array()),
        transform(if(last >= first - held, sequence(first - held, last), array()), i -> named_struct('at', i, 'own', i >= first)))"""))
    return rows.select("conv", F.col("sample").cast("int").alias("sample"), place.alias("p")).select("conv", "sample", F.col("p.at").alias("pos"), F.col("p.own").alias("own"))


def samples(df: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """conv_id, sample, formatted, repeated (leading turns that are repeats), loss (start, length in code points).

    Turns are ordered by turn (NULL first), then role and text; repeated rows are turns of their own. NULL
    roles and texts are empty; a NULL conversation id is a conversation. A turn above the budget is a
    sample of its own. Other columns are ignored; an empty table gives an empty result.
    """
    turns = cut(_turns(df, conv_col, turn_col, role_col, text_col), "chat-rows")
    spans = _spans(turns, budget, history, chunk).withColumnRenamed("conv", "c").withColumnRenamed("pos", "p")
    # merged: the estimate of the exploded spans is far below their size, so the planner would broadcast them
    held = turns.join(spans.hint("merge"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("pos") == F.col("p")))
    one = held.groupBy("conv", "sample").agg(F.sort_array(F.collect_list(F.struct("pos", "own", "rendered", "head", "body", "target"))).alias("t"))
    one = one.withColumn("formatted", F.array_join(F.transform("t", lambda x: x["rendered"]), ""))
    loss = F.expr("""
        aggregate(t, named_struct('at', 0, 'loss', cast(array() as array<struct<start:int,length:int>>)),
          (a, x) -> named_struct('at', a.at + length(x.rendered), 'loss',
            if(x.own and x.target, a.loss || array(named_struct('start', a.at + x.head, 'length', x.body)), a.loss)), a -> a.loss)""")
    return one.select(F.col("conv").alias(conv_col), "sample", "formatted", F.size(F.filter("t", lambda x: ~x["own"])).alias("repeated"), loss.alias("loss"))


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the samples say of each conversation, from their text and mask alone.

    n_turns, turns_sha256 (of role, newline, text, newline per turn), loss_chars, loss_sha256 (of all text
    under the mask), formatted_chars.
    """
    pieces = F.slice(F.split("formatted", r"<\|im_end\|>"), F.col("repeated") + 1, F.greatest(F.size(F.split("formatted", r"<\|im_end\|>")) - 1 - F.col("repeated"), F.lit(0)))

    def turn(x: Column) -> Column:
        part = F.split(F.substr(x, F.lit(len(START) + 1)), r"<\|im_sep\|>")
        return F.concat(unescape(part[0]), F.lit("\n"), unescape(part[1]), F.lit("\n"))

    said = formatted.select(
        F.col(conv_col).alias("conv"), "sample", F.length("formatted").alias("chars"), F.size(pieces).alias("n"),
        F.array_join(F.transform(pieces, turn), "").alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"]))), "").alias("target"))
    whole = said.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("sample", "turns", "target"))).alias("s"),
                                     F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    text = F.array_join(F.transform("s", lambda x: x["target"]), "")
    return whole.select(F.col("conv").alias(conv_col), F.col("n").cast("long").alias("n_turns"),
                        F.sha2(F.array_join(F.transform("s", lambda x: x["turns"]), ""), 256).alias("turns_sha256"),
                        F.length(text).cast("long").alias("loss_chars"), F.sha2(text, 256).alias("loss_sha256"),
                        F.col("chars").cast("long").alias("formatted_chars"))
