"""Quotation linking (native): threads of messages from the passages that they quote.

The lines of a message are parsed into quote levels (the number of leading ``>``); runs of lines of
one level are passages. Quoted passages are normalised (case, white space) and hashed, and joined to
the hashes of the own passages of other messages. The parent of a message is the original of its
shallowest linked passage; parents lead to the root of a thread by pointer doubling.

Of several messages with the same own passage the earliest one of the same scope counts as the
original, else the earliest one anywhere, so every quoted passage joins at most one row of each
table however often a text occurs. An original is always earlier (order, then scope, then key) than
the message that quotes it, so there are no cycles.

Defined cases: null and empty texts have no passages and are roots; rows that are equal in scope,
order, role and text are one message; null scopes or orders come first. Other columns may have any
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmine.session import stage

_MARKS = "^[ \\t]*(>[ \\t]*)*"


def _normal(text: Column) -> Column:
    folded = F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))  # as upper-casing has it
    return F.btrim(F.regexp_replace(folded, "\\s+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """msg, run, level, text: runs of lines of one quote level; ``messages`` has msg and body."""
    lines = messages.select("msg", F.posexplode(F.split("body", "\r?\n")).alias("pos", "line"))
    mark = F.regexp_extract("line", _MARKS, 0)
    lines = lines.select(
        "msg", "pos", (F.length(mark) - F.length(F.replace(mark, F.lit(">"), F.lit("")))).alias("level"),
        F.when(F.contains(mark, F.lit(">")), F.regexp_replace("line", _MARKS, "")).otherwise(F.col("line")).alias("text"))
    order = Window.partitionBy("msg").orderBy("pos")  # the lines of one message
    turn = F.when(F.col("level") == F.lag("level").over(order), 0).otherwise(1)
    runs = lines.withColumn("turn", turn).withColumn("run", F.sum("turn").over(order))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n")
    return runs.groupBy("msg", "run", "level").agg(joined.alias("text"))


def _hashed(found: DataFrame) -> DataFrame:
    return found.withColumn("normal", _normal(F.col("text"))).where("normal <> ''").withColumn("hash", F.md5("normal")).drop("normal")


def _roots(parents: DataFrame) -> DataFrame:
    """msg, root and depth from msg and parent (null at a root), by pointer doubling."""
    # up: the message reached so far; a root reaches itself with no steps and is settled at once.
    ways = stage(parents.select(
        "msg", F.coalesce("parent", "msg").alias("up"), F.col("parent").isNotNull().cast("long").alias("steps"),
        F.col("parent").isNull().alias("settled")), "ways")
    settled, moving = ways.where("settled"), ways.where("NOT settled")
    while not moving.isEmpty():  # only messages that have not reached their root are joined again
        further = settled.unionByName(moving).select(
            F.col("msg").alias("_up"), F.col("up").alias("_far"), F.col("steps").alias("_more"), F.col("settled").alias("_settled"))
        after = stage(moving.join(further, moving["up"] == further["_up"]).select(
            "msg", F.col("_far").alias("up"), (F.col("steps") + F.col("_more")).alias("steps"),
            F.col("_settled").alias("settled")), "ways")
        settled, moving = settled.unionByName(after.where("settled")), after.where("NOT settled")
    return settled.select("msg", F.col("up").alias("root"), F.col("steps").alias("depth"))


def link(messages: DataFrame, scope: str, order: str, role: str, body: str) -> DataFrame:
    """A row per message: scope, order, role, parent_scope, parent_order, thread_scope, thread_order,
    depth, n_quotes, n_linked, text (own lines only). Sort by thread, depth and order for the
    conversation; a thread's parent precedes its replies in that order."""
    rows = messages.select(
        messages[scope].alias("scope"), messages[order].alias("ord"), messages[role].alias("role"),
        F.coalesce(messages[body], F.lit("")).alias("body")).distinct()
    key = F.md5(F.to_json(F.struct("scope", "ord", "role", "body"), {"ignoreNullFields": "false"}))
    rows = stage(rows.withColumn("msg", key), "messages")
    found = stage(passages(rows), "passages")
    rank = F.struct("ord", "scope", "msg")
    places = rows.select("msg", "scope", "ord")
    own = _hashed(found.where("level = 0").select("msg", "text")).join(places, "msg")
    whole = found.where("level = 0").groupBy("msg").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "\n").alias("text"))
    own = own.unionByName(_hashed(whole).join(places, "msg")).distinct()
    near = own.groupBy(F.col("scope").alias("_scope"), F.col("hash").alias("_hash")).agg(F.min(rank).alias("near"))
    far = own.groupBy(F.col("hash").alias("_h")).agg(F.min(rank).alias("far"))
    quoted = _hashed(found.where("level > 0")).join(places, "msg")
    quoted = quoted.join(near, quoted["scope"].eqNullSafe(near["_scope"]) & (quoted["hash"] == near["_hash"]), "left")
    quoted = quoted.join(far, quoted["hash"] == far["_h"], "left")
    source = F.when(F.col("near") < rank, F.col("near")).when(F.col("far") < rank, F.col("far"))
    linked = quoted.withColumn("source", source).groupBy("msg").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("source").alias("n_linked"),
        F.min(F.when(F.col("source").isNotNull(), F.struct("level", "run", "source")))["source"].alias("parent"))
    linked = stage(linked, "quote-links")
    parents = rows.select("msg").join(linked.select("msg", F.col("parent.msg").alias("parent")), "msg", "left")
    roots = _roots(parents)
    heads = rows.select(F.col("msg").alias("root"), F.col("scope").alias("thread_scope"), F.col("ord").alias("thread_order"))
    told = rows.drop("body").join(roots, "msg").join(heads, "root").join(linked, "msg", "left").join(whole, "msg", "left")
    return told.select(
        "scope", F.col("ord").alias("order"), "role", F.col("parent.scope").alias("parent_scope"),
        F.col("parent.ord").alias("parent_order"), "thread_scope", "thread_order", "depth",
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\r\n")).alias("text"))


def _quoting(text: Column, marks: str) -> Column:
    return F.when(text.isNotNull() & (text != ""), F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks), F.lit("\n"))).otherwise("")


def as_mail(conversations: DataFrame) -> DataFrame:
    """Turns as mail: every turn quotes the turn before it, and that one's predecessor a level deeper."""
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    once = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("t"))

    def earlier(by: int) -> DataFrame:
        return once.select(F.col("conv_id").alias(f"c{by}"), (F.col("turn") + by).alias(f"n{by}"), F.col("t").alias(f"t{by}"))

    out = turns
    for by in (1, 2):
        before = earlier(by)
        out = out.join(before, out["conv_id"].eqNullSafe(before[f"c{by}"]) & (out["turn"] == before[f"n{by}"]), "left")
    body = F.concat(_quoting(F.col("t2"), "> > "), _quoting(F.upper("t1"), "> "), F.coalesce("text", F.lit("")))
    return out.select("conv_id", "turn", "role", body.alias("body"))


def op4(conversations: DataFrame) -> DataFrame:
    linked = link(as_mail(conversations), "conv_id", "turn", "role", "body")
    return linked.withColumnsRenamed({
        "scope": "conv_id", "order": "turn", "parent_scope": "parent_conv", "parent_order": "parent_turn",
        "thread_scope": "thread_conv", "thread_order": "thread_turn"})
