"""Fuzzy linking of activity labels to an occupation vocabulary.

Labels repeat, so every distinct label is scored once and the result joined back.
A label is only ever compared with aliases that can score on it: each alias
publishes a few anchors, each label looks its own up, and one equi-join finds the
candidates.  No pair that can reach the threshold is missed:

* alias inside label - the label holds the alias's first letters (``GRAM`` or fewer);
* label inside alias - the alias holds the label's first ``GRAM`` letters;
* shared words - of the ``m`` words of an alias that needs ``k`` of them, at least
  one of any ``m - k + 1`` must be shared; those that fewest labels hold are taken.

What is joined are numbers: a hash for the label, one for the anchor, and the place of the
alias.  Texts come back once the pairs are distinct.  Equal hashes of different texts or anchors
only make candidates, and a candidate counts by its score.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitarium import fixed
from vitarium.functions.text import first_truthy, match_key, qs_date, qs_quote, split_activities
from vitarium.operators.records import Seq
from vitarium.operators.skew import lookup_join, seq_columns
from vitarium.schema import SEEDS

GRAM = 6
#: The bit map of anchors has this many words of 64 bits.
MAP_WORDS = 1 << 12
#: What tells one alias from another.
ALIAS = ["seed_pos", "alias_pos"]


def occupation_seeds(spark: SparkSession, seeds: Sequence[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """A seeds table from ``(qid, label, aliases)`` triples; default: the built-in vocabulary."""
    rows = fixed.OCCUPATIONS if seeds is None else seeds
    return spark.createDataFrame([(pos, *row) for pos, row in enumerate(rows)], SEEDS)


def occupation_model(seeds: DataFrame) -> DataFrame:
    """One row per alias, normalised.  An alias with no letter or digit is an error."""
    aliases = seeds.select("seed_pos", "qid", "label", F.posexplode("aliases").alias("alias_pos", "__raw"))
    alias = match_key("__raw")
    problem = F.concat(F.lit("alias without letters or digits for "), "qid")
    checked = F.when(alias == "", F.raise_error(problem).cast("string")).otherwise(alias)
    return aliases.withColumn("alias", checked).drop("__raw").withColumn("alias_tokens", F.split("alias", " "))


def score(pairs: DataFrame) -> DataFrame:
    """Adds ``confidence``, the rounded score of label ``text`` against ``alias``, both normalised."""
    lengths = (F.length("text"), F.length("alias"))
    contained = fixed.SCORE_CONTAINED_BASE + (fixed.SCORE_CONTAINED_SPAN * F.least(*lengths)) / F.greatest(*lengths)
    # words an alias repeats count each time
    shared = F.size(F.filter("alias_tokens", lambda word: F.array_contains("__words", word)))
    raw = (
        F.when(F.col("text") == "", 0.0)
        .when(F.col("text") == F.col("alias"), fixed.SCORE_EQUAL)
        .when(F.contains("text", "alias") | F.contains("alias", "text"), contained)
        .when(F.col("__shared") > 0, _token_score(F.col("__shared"), F.size("alias_tokens")))
        .otherwise(0.0)
    )
    # one step per column, so that what is used more than once is computed once
    return (
        pairs.withColumn("__words", F.split("text", " "))
        .withColumn("__shared", shared)
        .withColumn("__raw", raw)
        .withColumn("confidence", rounded(F.col("__raw")))
        .drop("__words", "__shared", "__raw")
    )


def rounded(value: Column) -> Column:
    """A score to three digits, decided by the exact value of the double.

    ``round()`` looks at the shortest decimal form and so lifts 0.7625, which as a
    double lies just below that, to 0.763 instead of 0.762.  Such values are found
    by an exact comparison with the half-way point: a double is the sum of its float
    part and a rest, and both times 2000 are exact.
    """
    thousandths = F.round(F.round(value, fixed.SCORE_DIGITS) * 1000)
    head = value.cast("float").cast("double")
    above_half = (head * 2000 - (thousandths * 2 - 1)) + (value - head) * 2000
    return F.when(above_half < 0, thousandths - 1).otherwise(thousandths) / 1000


def _token_score(shared: Column, total: Column) -> Column:
    return fixed.SCORE_TOKENS_BASE + fixed.SCORE_TOKENS_SPAN * (shared / total)


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the given lengths."""
    return F.concat(*[
        F.regexp_extract_all(text, F.lit(f"(?=(.{{{size}}}))"), F.lit(1)) for size in sizes])


def _tagged(tag: str, values: Column) -> Column:
    """Marks words ("=") and letters around a label ("<"); heads inside it stay bare."""
    return F.transform(values, lambda value: F.concat(F.lit(tag), value))


def _hashed(df: DataFrame, *ids: Column | str, anchors: Column) -> DataFrame:
    """One row per id and anchor, as numbers."""
    names = df.select(*ids).columns
    return df.select(*ids, F.explode(anchors).alias("anchor")).select(*names, F.xxhash64("anchor").alias("anchor"))


def _place(anchor: Column) -> tuple[Column, Column]:
    """Word and bit of the map that stand for an anchor."""
    return (F.shiftright(anchor, 6).bitwiseAND(F.lit(MAP_WORDS - 1)).cast("int"), anchor.bitwiseAND(F.lit(63)).cast("int"))


def _survey(model: DataFrame) -> tuple[list[int], Column]:
    """How short the aliases are, and a test whether a number may be an anchor of one.

    The test looks at a bit map of fixed size, which reaches the driver as one number per word.  Most of what labels
    publish is no anchor of any alias and goes no further than this.  With a larger vocabulary
    more bits are set and more goes on to the join, which decides.
    """
    heads = F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.substring(F.col("alias"), F.lit(1), n))
    every = F.concat(_tagged("=", F.col("alias_tokens")), _tagged("<", _grams(F.col("alias"), range(1, GRAM + 1))), heads)
    word, bit = _place(F.col("anchor"))
    rows = _hashed(model, F.least(F.length("alias"), F.lit(GRAM)).alias("size"), anchors=every).groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)), F.collect_set("size")).collect()
    bits = {r[0]: r[1] for r in rows}
    # one constant, folded into an array when the query is planned
    table = F.split(F.lit(",".join(str(bits.get(n, 0)) for n in range(MAP_WORDS))), ",").cast("array<bigint>")
    return sorted({size for r in rows for size in r[2]}), F.getbit(F.get(table, word), bit) == 1


def _rare_words(hits: DataFrame, model: DataFrame, min_confidence: float) -> DataFrame:
    """Words of each alias, of which a label must hold one if shared words are to reach the threshold.

    ``hits`` says how often labels hold each word of the vocabulary; an alias publishes the rarest.
    """
    words = model.select(*ALIAS, F.size("alias_tokens").alias("total"), F.explode(_tagged("=", F.col("alias_tokens"))).alias("word"))
    words = words.select(*ALIAS, "total", F.xxhash64("word").alias("anchor"))
    total = F.col("total")
    reaching = F.filter(
        F.sequence(F.lit(1), total),
        lambda k: rounded(_token_score(k, total)) >= min_confidence,
    )
    needed = F.get(reaching, F.lit(0))  # NULL if shared words alone cannot reach the threshold
    counts = hits.groupBy("anchor").agg(F.count("label_id").alias("n"))
    rarest = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "anchor")))
    ranked = words.join(counts, "anchor", "left").groupBy(*ALIAS, "total").agg(rarest.alias("ranked"))
    published = F.slice("ranked", F.lit(1), F.coalesce(total - needed + 1, F.lit(0)))
    return ranked.select(*ALIAS, F.explode(F.array_distinct(F.transform(published, lambda entry: entry["anchor"]))).alias("anchor"))


def candidates(labels: DataFrame, model: DataFrame, min_confidence: float) -> DataFrame:
    """Pairs ``(label_id, seed_pos, alias_pos)`` that may reach the threshold, each once."""
    lengths, may_be_anchor = _survey(model)
    if not lengths:
        raise ValueError("the occupation model has no aliases")
    # without very short aliases one head length serves all and labels publish fewer grams
    head_size = lengths[0] if lengths[0] >= 4 else GRAM
    heads = sorted({min(length, head_size) for length in lengths})
    lettered = _hashed(model, *ALIAS, anchors=F.array_distinct(F.concat(
        F.array(F.substring("alias", 1, head_size)),
        _tagged("<", _grams(F.col("alias"), range(1, GRAM + 1))),
    )))
    probes = _hashed(labels, label_id(), anchors=F.concat(
        _tagged("=", F.split("text", " ")),
        _grams(F.col("text"), heads),
        F.array(F.concat(F.lit("<"), F.substring("text", 1, GRAM))),
    ))
    # one exchange, counted for rarity and joined
    hits = probes.filter(may_be_anchor).repartition("anchor")
    anchors = lettered.unionByName(_rare_words(hits, model, min_confidence))
    return hits.join(anchors, "anchor").select("label_id", *ALIAS).distinct()


def label_id() -> Column:
    return F.xxhash64("text").alias("label_id")


def match_labels(labels: DataFrame, model: DataFrame, *, min_confidence: float = fixed.MIN_CONFIDENCE) -> DataFrame:
    """Occupations of each distinct normalised label (column ``text``).

    Gives ``text`` and ``seed_pos, qid, label, confidence`` where the
    best alias reaches ``min_confidence``.  If a qid occurs in several seeds, the first
    that does counts.
    """
    if not min_confidence > 0 or math.isinf(min_confidence):
        raise ValueError("min_confidence must be above 0: at 0 every label pairs with every occupation")
    pairs = candidates(labels, model, min_confidence)
    texts = labels.select(label_id(), "text")
    return (
        score(pairs.join(texts, "label_id").join(model, ALIAS))
        .groupBy("text", "seed_pos", "qid", "label")
        .agg(F.max("confidence").alias("confidence"))
        # after the aggregation, because before it the filter would score every pair twice
        .filter(F.col("confidence") >= min_confidence)
        .groupBy("text", "qid")
        .agg(
            F.min("seed_pos").alias("seed_pos"),
            F.min_by("label", "seed_pos").alias("label"),
            F.min_by("confidence", "seed_pos").alias("confidence"),
        )
    )


def activity_pieces(records: DataFrame, *, record_id: Seq, activity: str = "activity") -> DataFrame:
    """The distinct pieces of each record's activity text, in order, with their match key."""
    # the key is computed inside the array: once per piece, whatever is filtered on it later
    pieces = F.transform(
        F.array_distinct(split_activities(activity)),
        lambda piece: F.struct(piece.alias("raw"), match_key(piece).alias("text")),
    )
    ids = seq_columns(record_id)
    return (
        records.select(*ids, F.posexplode(pieces).alias("piece_pos", "piece"))
        .filter(F.col("piece.text") != "")
        .select(*ids, "piece_pos", F.col("piece.raw").alias("source_activity"), F.col("piece.text").alias("text"))
    )


def suggest(records: DataFrame, model: DataFrame, *, record_id: Seq, activity: str = "activity",
            min_confidence: float = fixed.MIN_CONFIDENCE) -> DataFrame:
    """Occupation suggestions of each record, ranked from 1.

    Ranked by confidence, then label in Polish order, then as met.  ``record_id``
    names the columns that identify a record.
    """
    ids = seq_columns(record_id)
    pieces = activity_pieces(records, record_id=ids, activity=activity)
    labels = pieces.select("text").distinct()
    matches = match_labels(labels, model, min_confidence=min_confidence)
    # dealt out by record before they are ranked: what is only wanted of the best is then sorted in
    # partitions of the size that adaptive execution chooses, and not in those of the join
    found = lookup_join(pieces, matches, "text", how="inner").repartition(*ids)
    order = Window.partitionBy(*ids).orderBy(
        F.col("confidence").desc(), F.collate("label", "pl"), "piece_pos", "seed_pos")
    return found.select(
        *ids,
        F.row_number().over(order).alias("rank"),
        "source_activity",
        F.col("qid").alias("occupation_qid"),
        F.col("label").alias("occupation_label"),
        "confidence",
    )


def best_suggestions(suggestions: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` best suggestions of each record."""
    return suggestions.filter(F.col("rank") <= k)


def statements(records: DataFrame, suggestions: DataFrame, *, record_id: Seq, activity: str = "activity",
               url: str = "url", qid: str = "wikidata_qid") -> DataFrame:
    """One reviewable statement per suggestion, with record id and rank in front.

    Records without suggestions have none.  Missing names and URLs fall back to the
    biography's.
    """
    ids = seq_columns(record_id)

    def either(*names):
        return first_truthy(*[n for n in names if n in records.columns])

    source_url = either(url, "biography_url")
    about = records.select(
        *ids,
        either("name", "biography_name").alias("name"),
        either(activity).alias("__activity"),
        either(qid).alias("item_qid"),
        source_url.alias("source_url"),
    )
    # a merge join: records look smaller beforehand than they are, and suggestions lie by record already
    return suggestions.join(about.hint("merge"), ids).select(
        *ids, "rank", "name",
        F.col("__activity").alias("activity"),
        "item_qid", "source_url", "source_activity", "occupation_qid", "occupation_label", "confidence",
        F.lit(fixed.OCCUPATION_PROPERTY).alias("property"),
        F.lit(fixed.REFERENCE_PROPERTY).alias("reference_property"),
        F.col("source_url").alias("reference_url"),
    )


def statement_columns(df: DataFrame) -> DataFrame:
    """The statement columns as they stand in files: record columns first."""
    return df.select(*fixed.STATEMENT_COLUMNS)


def quickstatements(df: DataFrame, retrieved: datetime.date | datetime.datetime | Column | None = None) -> DataFrame:
    """QuickStatements lines (column ``value``) of statements with an item and a URL.

    ``retrieved`` is the retrieval date, default today (UTC session).
    """
    moment = F.current_date() if retrieved is None else retrieved
    if not isinstance(moment, Column):
        if isinstance(moment, datetime.datetime) and moment.tzinfo:
            moment = moment.astimezone(datetime.timezone.utc)
        moment = F.lit(moment.strftime("%Y-%m-%d")).cast("date")
    return df.filter((F.col("item_qid") != "") & (F.col("reference_url") != "")).select(
        F.concat_ws(
            "\t",
            "item_qid",
            F.lit(fixed.OCCUPATION_PROPERTY),
            "occupation_qid",
            F.lit(fixed.QS_REFERENCE_URL),
            qs_quote("reference_url"),
            F.lit(fixed.QS_RETRIEVED),
            qs_date(moment),
        ).alias("value")
    )
