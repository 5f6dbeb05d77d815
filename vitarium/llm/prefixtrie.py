"""Trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of a conversation's first turns, its members are the conversations
that begin with it.  A prefix is named by 128 bits: the XOR of one hash a turn, taken of depth,
role and text, so that stripping the last turn is one XOR and running names need no order of joins.

Equal conversations are one row with a weight.  Of a conversation alone with its prefix from
some depth on, all turns beyond are its own chain: their figures follow from running sums, and
the whole chain is stripped in one step.  Peeling starts at the deepest prefix where different
conversations meet: at each such depth, going up, conversations that end or whose chain was stripped
here are merged with the surviving nodes, which gives the depth's nodes with all their figures; what
is left is stripped of its last turns, up to the next prefix where others join or end, and regrouped there.
Prefixes in between have the same members; their figures follow from running sums too.  Each depth is
written and read again, so there are as many rounds as depths where conversations meet.

Rows are combined per task before they are shuffled, so a prefix that holds a large share of all
conversations sends one row a task.  Places and running names of a conversation that holds a large
share of all turns are counted in parts.  Members that end at one node are hashed as a stream of
ready pieces.

Turns go by ``turn``, nulls first, then by role, then by the MD5 of the text; a null role or text
is empty.  Rows of a null conversation take no part.  Repeated rows are turns each.  A conversation
without turns is a member of the root.  Without conversations there are no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitarium.llm.quality import words_of
from vitarium.session import scratch_path, stored

#: Turns of a conversation whose running names are made together.
PART_TURNS = 1024
#: Numbers of conversations whose names are joined to one piece before they are hashed.
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as ``conv, place`` (from 1), two hashes of role and text, and words; texts do not travel."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = df.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), role_.alias("role"),
        F.md5(text_).alias("tie"), F.xxhash64(F.lit(1), role_, text_).alias("a"), F.xxhash64(F.lit(2), role_, text_).alias("b"),
        F.size(words_of(text_)).cast("long").alias("words")).filter("conv is not null")
    keys = ["conv", "turn", "role", "tie"]
    runs = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "conv", "a", "b", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "turns")
    # a conversation may lie in several partitions: what stands before each of its runs
    starts = runs.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("conv", "part", (F.col("first") - before - 1).alias("zero"))
    return stored(runs.join(starts, ["conv", "part"]).select("conv", (F.col("at") - F.col("zero")).alias("place"), "a", "b", "words"),
                  "places")


def with_shared_heads(turns: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first ``head`` turns come from conversation ``base``, the others stay.

    ``head`` and ``base`` are expressions on ``conv``.  Gives the rebuilt turns (``depth`` for place) and the
    names of all conversations.
    """
    convs = stored(turns.groupBy("conv").agg(F.count("*").alias("n")).select("conv", "n", head.alias("head"), base.alias("base")),
                   "conversations")
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    lead = F.coalesce(F.least("head", "base_n"), F.lit(0))
    convs = convs.join(bases, "base", "left").withColumn("lead", lead.cast("long"))
    own = turns.join(convs.select("conv", "head", "lead"), "conv").filter(F.col("place") > F.col("head")).select(
        "conv", (F.col("place") - F.col("head") + F.col("lead")).alias("depth"), "a", "b", "words")
    most = convs.agg(F.max("head")).first()[0] or 0
    heads = turns.filter(F.col("place") <= most).withColumnRenamed("conv", "base")
    taken = convs.filter("lead > 0").select("conv", "base", "lead").join(heads, "base").filter(
        F.col("place") <= F.col("lead")).select("conv", F.col("place").alias("depth"), "a", "b", "words")
    return own.unionByName(taken), convs.select("conv")


def _digests(batches):
    """SHA-256 of the comma-joined pieces of each name, which come one after another."""
    state, digest = None, None

    def row():
        (k1, k2), conv, weight, depth, total = state
        return [k1, k2, conv, weight, depth, total, digest.hexdigest()]

    for batch in batches:
        out = []
        for k1, k2, depth, total, conv, weight, text in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or state[0] != (k1, k2):
                if state is not None:
                    out.append(row())
                state, digest = [(k1, k2), conv, weight, depth, total], hashlib.sha256(text.encode())
            else:
                state[1], state[2] = min(state[1], conv), state[2] + weight
                digest.update(b"," + text.encode())
        yield _batch(out)
    if state is not None:
        yield _batch([row()])


_NAMES = ["k1", "k2", "conv", "weight", "depth", "total", "ends"]
_SCHEMA = "k1 bigint, k2 bigint, conv bigint, weight bigint, depth bigint, total bigint, ends string"


def _batch(rows):
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())],
                                      names=_NAMES)


def _distinct(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct conversation: name, least member, members, turns, words, and the digest of its members."""
    whole = turns.groupBy("conv").agg(F.bit_xor("h1").alias("k1"), F.bit_xor("h2").alias("k2"), F.count("*").alias("depth"),
                                      F.sum("words").alias("total"))
    whole = convs.join(whole, "conv", "left").na.fill(0)
    # ids of one piece lie within PIECE numbers, so a piece holds at most that many
    pieces = whole.groupBy("k1", "k2", "depth", "total", F.floor(F.col("conv") / PIECE).alias("piece")).agg(
        F.min("conv").alias("conv"), F.count("*").alias("weight"),
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("text"))
    in_order = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece")
    return in_order.select("k1", "k2", "depth", "total", "conv", "weight", "text").mapInArrow(_digests, _SCHEMA)


def _prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: its name ``k``, its name without the last turn ``p``, words before it."""
    part = F.floor((F.col("depth") - 1) / PART_TURNS).alias("part")
    turns = turns.select("*", part)
    sums = [F.bit_xor("h1"), F.bit_xor("h2"), F.sum("words")]
    upto = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = turns.select("*", *(s.over(upto).alias(f"s{i}") for i, s in enumerate(sums)))
    # only long conversations have more than one part
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = turns.filter(F.col("total_turns") > PART_TURNS).groupBy("conv", "part").agg(
        *(s.alias(c) for s, c in zip(sums, ("h1", "h2", "words"))))
    lead = totals.select("conv", "part", *(s.over(earlier).alias(f"e{i}") for i, s in enumerate(sums)))
    joined = running.join(lead, ["conv", "part"], "left")
    k = [F.col(f"s{i}").bitwiseXOR(F.coalesce(f"e{i}", F.lit(0).cast("long"))) for i in (0, 1)]
    words = F.col("s2") + F.coalesce("e2", F.lit(0).cast("long"))
    return joined.select("conv", "depth", k[0].alias("k1"), k[1].alias("k2"), k[0].bitwiseXOR(F.col("h1")).alias("p1"),
                         k[1].bitwiseXOR(F.col("h2")).alias("p2"), "words", (words - F.col("words")).alias("before"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie.

    ``turns`` has ``conv, depth`` (from 1, without gaps), two hashes ``a, b`` of the turn, and ``words``;
    ``convs`` names all conversations, those without turns too.
    """
    spark = turns.sparkSession
    hashes = [F.xxhash64(F.lit(i), "depth", "a", "b").alias(f"h{i}") for i in (1, 2)]
    turns = stored(turns.select("conv", "depth", "words", *hashes), "turns")
    rows = stored(_distinct(turns, convs), "distinct")
    some = rows.select("conv", F.col("depth").alias("total_turns"))
    prefixes = stored(_prefixes(turns.join(some, "conv")), "prefixes")

    # where a conversation is first alone with its prefix; above that it shares it
    counts = stored(prefixes.groupBy("depth", "k1", "k2").agg(F.count("*").alias("n"), F.min("conv").alias("conv")), "counts")
    tops = counts.filter("n = 1").groupBy("conv").agg(F.min("depth").alias("top"))
    rows = stored(rows.join(tops, "conv", "left").withColumn(
        "meets", F.when(F.col("top") == 1, F.lit(0)).otherwise(F.coalesce(F.col("top") - 1, "depth"))).withColumnRenamed(
            "depth", "turns"), "rows")
    marked = prefixes.join(rows.select("conv", "turns", "meets", "weight", "total", "ends"), "conv")
    more = F.col("depth") < F.col("turns")
    chain = marked.filter("depth > meets").select(
        "conv", "depth", "k1", "k2", "p1", "p2", F.col("weight").alias("n_convs"), more.cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("weight") - 1) * (F.col("total") - F.col("before"))).alias("saved"),
        F.when(more, F.lit(NO_ENDS)).otherwise(F.col("ends")).alias("ends"), (F.col("depth") == F.col("meets") + 1).alias("top"))
    chain = stored(chain, "chains")
    figures = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    below = chain.filter("not top").withColumn("parent_conv", F.col("conv")).select(*figures)
    if rows.isEmpty():
        return below
    # a shared prefix whose members all go on alike has a child with as many; at the others conversations meet
    several = counts.filter("n > 1")
    alike = several.select("conv", (F.col("depth") - 1).alias("depth"), "n")
    meeting = several.join(alike, ["conv", "depth", "n"], "left_anti").select("k1", "k2", "depth", F.lit(True).alias("meet"))
    depths = sorted({0, *(r[0] for r in meeting.select("depth").distinct().collect())})
    path = Window.partitionBy("conv").orderBy("depth")
    at = F.when(F.col("meet"), F.struct("depth", "k1", "k2", (F.col("before") + F.col("words")).alias("upto")))
    shared = marked.filter("depth <= meets").select("conv", "depth", "k1", "k2", "p1", "p2", "words", "before").join(
        meeting, ["k1", "k2", "depth"], "left")
    shared = stored(shared.select(
        "conv", "depth", "k1", "k2", "p1", "p2", "words", "before", F.coalesce("meet", F.lit(False)).alias("meet"),
        F.last(at, True).over(path.rowsBetween(Window.unboundedPreceding, -1)).alias("up"),
        F.min(F.when(F.col("meet"), F.col("depth"))).over(path.rowsBetween(0, Window.unboundedFollowing)).alias("next")
    ).sortWithinPartitions("depth"), "shared")

    # conversations enter where their chain is stripped off, or where they end
    stripped = chain.filter("top").select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv", "n_convs",
        F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends"))
    ended = rows.filter("top is null").select(
        F.col("turns").alias("depth"), "k1", "k2", "conv", F.col("weight").alias("n_convs"),
        *(F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved")), "ends")
    folder = scratch_path(spark, "peeled")
    entering = stripped.unionByName(ended)
    entering.write.partitionBy("depth").parquet(f"{folder}/waiting")
    waiting = StructType([f for f in entering.schema if f.name != "depth"])
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    for depth in reversed(depths):
        here = spark.read.schema(waiting).parquet(f"{folder}/waiting/depth={depth}")
        nodes = here.groupBy("k1", "k2").agg(
            F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
            F.max("ends").alias("ends"))
        if depth:
            nodes = nodes.join(shared.filter((F.col("depth") == depth) & F.col("meet")).select(
                "conv", "p1", "p2", "words", "before", "up"), "conv")
        else:
            nodes = nodes.select("*", *(none.alias(c) for c in ("p1", "p2")), *(zero.alias(c) for c in ("words", "before")),
                                 F.lit(None).cast(shared.schema["up"].dataType).alias("up"))
        nodes = nodes.select(
            "conv", F.lit(depth).cast("long").alias("depth"), "k1", "k2", "p1", "p2", "n_convs", "n_children",
            F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
            "before", "up")
        nodes.write.parquet(f"{folder}/nodes/{depth}")
        if depth:  # what is left waits where it next meets others
            done = spark.read.schema(nodes.schema).parquet(f"{folder}/nodes/{depth}")
            between = F.col("before") - F.coalesce("up.upto", zero)
            done.select(
                F.coalesce("up.depth", F.lit(0)).alias("depth"), F.coalesce("up.k1", zero).alias("k1"), F.coalesce("up.k2", zero).alias("k2"),
                "conv", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
                (F.col("saved") + (F.col("n_convs") - 1) * between).alias("saved"), F.lit(None).cast("string").alias("ends"),
            ).write.mode("append").partitionBy("depth").parquet(f"{folder}/waiting")
    peeled = spark.read.schema(nodes.schema).parquet(*(f"{folder}/nodes/{depth}" for depth in depths))
    # prefixes on the way from one meeting to the next, by the member that names them
    ends_at = peeled.select("conv", F.col("depth").alias("next"), "n_convs", "n_leaves", "saved", F.col("before").alias("last"))
    ways = shared.filter(~F.col("meet")).join(ends_at, ["conv", "next"]).select(
        "conv", "depth", "k1", "k2", "p1", "p2", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("last") - F.col("before"))).alias("saved"), F.lit(NO_ENDS).alias("ends"))
    peeled = peeled.drop("before", "up").unionByName(ways)
    names = peeled.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                          F.col("conv").alias("parent_conv"))
    rest = chain.filter("top").drop("top").unionByName(peeled)
    return rest.join(names, ["p1", "p2", "depth"], "left").select(*figures).unionByName(below)
