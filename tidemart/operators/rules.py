"""Dynamic rules: ingestion, lifecycle, per-rule key fan-out, threshold alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from tidemart.operators.asof import as_of_join
from tidemart.functions.records import with_evaluated
from tidemart.functions.times import parse_ms
from tidemart.operators.keyed import first_per_key
from tidemart.schemas import RULE_JSON, TRANSACTION_JSON
from tidemart.session import stored

# Names a rule may use.
RULE_STATES = ("ACTIVE", "PAUSE", "DELETE", "CONTROL")
AGGREGATORS = ("SUM", "AVG", "MIN", "MAX")
LIMIT_OPERATORS = {"=": "EQUAL", "!=": "NOT_EQUAL", ">=": "GREATER_EQUAL",
                   "<=": "LESS_EQUAL", ">": "GREATER", "<": "LESS"}
CONTROLS = ("CLEAR_STATE_ALL", "CLEAR_STATE_ALL_STOP", "DELETE_RULES_ALL", "EXPORT_RULES_CURRENT")
PAYMENT_TYPES = ("CSH", "CRD")
RULE_TOKENS = 9
TRANSACTION_TOKENS = 7

LIMIT_TYPE = "decimal(28,4)"


def _one_of(column: Column, names) -> Column:
    return F.coalesce(column.isin(*names), F.lit(False))


def _null_or_one_of(column: Column, names) -> Column:
    return column.isNull() | column.isin(*names)


def _integer(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
                  text.try_cast(LIMIT_TYPE))


def parse_rules(feed: DataFrame, value: str = "value") -> DataFrame:
    """Rule lines as rule columns plus ``valid``.

    A line that starts with a brace is JSON and may use only the known fields; any other
    line has nine comma-separated tokens in round brackets, names joined by ``&``.  A line
    is valid when it parses and, unless it is a control, has a rule id.
    """
    line = F.col(value)
    is_json = F.coalesce(line.startswith("{"), F.lit(False))
    json_schema = T.StructType(RULE_JSON.fields + [T.StructField("_corrupt", T.StringType())])
    record = F.when(is_json, F.from_json(
        line, json_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    # Trailing empty tokens do not count.
    tokens = F.when(~is_json, F.split(F.regexp_replace(line, r",+$", ""), ","))
    parsed = with_evaluated(feed, "_parsed", F.struct(record.alias("json"), tokens.alias("tokens")))
    parsed = parsed.select("*", F.col("_parsed.json").alias("_json"),
                           F.col("_parsed.tokens").alias("_tokens"))

    j = {field.name: F.col(f"_json.{field.name}") for field in RULE_JSON.fields}
    t = [F.regexp_replace(F.get("_tokens", F.lit(i)), r"[()]", "") for i in range(RULE_TOKENS)]

    def names(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "&"))

    symbol_names = F.create_map(*[F.lit(x) for pair in LIMIT_OPERATORS.items() for x in pair])
    json_ok = (F.col("_json").isNotNull() & F.col("_json._corrupt").isNull()
               & (F.size(F.array_except(F.json_object_keys(line),
                                        F.array(*[F.lit(name) for name in RULE_JSON.fieldNames()])))
                  == 0)
               & _null_or_one_of(j["ruleState"], RULE_STATES)
               & _null_or_one_of(j["aggregatorFunctionType"], AGGREGATORS)
               & _null_or_one_of(j["limitOperatorType"], LIMIT_OPERATORS.values())
               & _null_or_one_of(j["controlType"], CONTROLS)
               & (j["ruleId"].isNotNull()
                  | F.coalesce(j["ruleState"] == "CONTROL", F.lit(False))))
    plain_ok = ((F.size("_tokens") == RULE_TOKENS)
                & _integer(t[0]).isNotNull() & _one_of(F.upper(t[1]), RULE_STATES)
                & _one_of(F.upper(t[5]), AGGREGATORS)
                & _decimal(t[7]).isNotNull() & _integer(t[8]).isNotNull())
    plain = {
        "rule_id": _integer(t[0]), "rule_state": F.upper(t[1]),
        "grouping_keys": names(t[2]), "unique_keys": names(t[3]), "aggregate_field": t[4],
        "aggregator": F.upper(t[5]), "limit_operator": F.element_at(symbol_names, t[6]),
        "limit_value": _decimal(t[7]), "window_minutes": _integer(t[8]),
        "control_type": F.lit(None).cast("string")}
    from_json = dict(zip(plain, (
        j["ruleId"], j["ruleState"], j["groupingKeyNames"], j["unique"], j["aggregateFieldName"],
        j["aggregatorFunctionType"], j["limitOperatorType"], j["limit"].cast(LIMIT_TYPE),
        j["windowMinutes"], j["controlType"])))
    rest = [name for name in feed.columns if name != value]
    return parsed.select(
        *[F.when(is_json, from_json[name]).otherwise(plain[name]).alias(name) for name in plain],
        *rest, F.col(value).alias("_raw"),
        F.coalesce(F.when(is_json, json_ok).otherwise(plain_ok), F.lit(False)).alias("valid"))


def valid_rules(parsed: DataFrame) -> DataFrame:
    return parsed.filter("valid").drop("_raw", "valid")


def dropped_rules(parsed: DataFrame) -> DataFrame:
    return parsed.filter("NOT valid").select(F.col("_raw").alias("raw"), *[
        name for name in ("seq",) if name in parsed.columns])


def active_rules(rules: DataFrame, seq: str = "seq") -> DataFrame:
    """The rules in force: last state per rule since the last delete-all, if active."""
    is_control = F.coalesce(F.col("rule_state") == "CONTROL", F.lit(False))
    wiped = (rules.filter(is_control & (F.col("control_type") == "DELETE_RULES_ALL"))
                  .agg(F.coalesce(F.max(seq), F.lit(-1)).alias("seq")))
    alive = rules.filter(~is_control & (F.col(seq) > wiped.scalar()))
    last = first_per_key(alive, ["rule_id"], [F.col(seq).desc()])
    return last.filter(F.col("rule_state") == "ACTIVE")


def parse_transactions(feed: DataFrame, value: str = "value",
                       ingested_ms: int | None = None) -> DataFrame:
    """Transactions from JSON text, or from seven comma-separated tokens.

    Malformed lines are dropped.  JSON records are stamped with the time of ingestion (now
    unless given); token records bring their own.
    """
    line = F.col(value)
    is_json = F.coalesce(line.startswith("{"), F.lit(False))
    schema = T.StructType(TRANSACTION_JSON.fields + [T.StructField("_corrupt", T.StringType())])
    record = F.when(is_json, F.from_json(
        line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    tokens = F.when(~is_json, F.split(F.regexp_replace(line, r",+$", ""), ","))
    parsed = with_evaluated(feed, "_parsed", F.struct(record.alias("json"), tokens.alias("tokens")))
    parsed = parsed.select("*", F.col("_parsed.json").alias("_json"),
                           F.col("_parsed.tokens").alias("_tokens"))
    j = {field.name: F.col(f"_json.{field.name}") for field in TRANSACTION_JSON.fields}
    t = [F.get("_tokens", F.lit(i)) for i in range(TRANSACTION_TOKENS)]

    def long(text: Column) -> Column:
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))

    amount = F.when(_decimal(t[5]).isNotNull(), t[5].try_cast("decimal(18,2)"))
    plain = {
        "transactionId": long(t[0]), "eventTime": parse_ms(t[1]), "payeeId": long(t[2]),
        "beneficiaryId": long(t[3]), "paymentAmount": amount,
        "paymentType": F.when(t[4].isin(*PAYMENT_TYPES), t[4]), "ingestionTimestamp": long(t[6])}
    plain_ok = ((F.size("_tokens") == TRANSACTION_TOKENS)
                & plain["transactionId"].isNotNull() & plain["eventTime"].isNotNull()
                & plain["payeeId"].isNotNull() & plain["beneficiaryId"].isNotNull()
                & amount.isNotNull() & plain["ingestionTimestamp"].isNotNull())
    json_ok = (F.col("_json").isNotNull() & F.col("_json._corrupt").isNull()
               & _null_or_one_of(j["paymentType"], PAYMENT_TYPES))
    now = (F.unix_millis(F.current_timestamp()) if ingested_ms is None
           else F.lit(ingested_ms).cast("bigint"))
    # Identifiers and time are plain numbers: absent in JSON means zero.
    zero = F.lit(0).cast("bigint")
    stamped = dict(j, ingestionTimestamp=now, **{
        name: F.coalesce(j[name], zero)
        for name in ("transactionId", "eventTime", "payeeId", "beneficiaryId")})
    valid = F.coalesce(F.when(is_json, json_ok).otherwise(plain_ok), F.lit(False))
    rest = [name for name in feed.columns if name != value]
    return parsed.filter(valid).select(
        *[F.when(is_json, stamped[name]).otherwise(plain[name]).alias(name) for name in plain],
        *rest)


# ---- fan-out --------------------------------------------------------------------------

def _unusable() -> Column:
    """Why a rule cannot be applied, or null."""
    return (F.when(F.col("window_minutes").isNull(), "no_window")
             .when(F.col("window_minutes") < 0, "negative_window")
             .when(F.col("limit_operator").isNull(), "no_operator")
             .when(F.col("aggregator").isNull(), "no_aggregator"))


def usable_rules(active: DataFrame) -> DataFrame:
    """Rules in force that can be applied; a window of 0 means the moment itself."""
    return active.filter(_unusable().isNull())


def unusable_rules(active: DataFrame) -> DataFrame:
    return active.withColumn("reason", _unusable()).filter(F.col("reason").isNotNull())


def rules_in_force(active: DataFrame) -> DataFrame:
    """One row: how many rules are applied and how many cannot be."""
    return active.agg(F.count_if(_unusable().isNull()).alias("applied"),
                      F.count_if(_unusable().isNotNull()).alias("unusable"))


def fan_out(transactions: DataFrame, rules: DataFrame, slots: int = 64,
            metric: Observation | None = None) -> DataFrame:
    """Every transaction once per usable rule, with the rule's key and fields.

    The key reads ``{name=value;name=value}``, ``{}`` for a rule without names; a field
    without a value reads ``null``.  ``metric`` receives the number of rules in force.

    An equi-join: transactions are dealt over ``slots`` by hash and every slot has all
    rules.  Spark broadcasts the rules if it measures them small; else the slots spread
    both sides, and nothing passes through the driver.
    """
    rules = usable_rules(rules)
    if metric is not None:
        rules = rules.observe(metric, F.count(F.lit(1)).alias("active_rules"))
    rule = rules.select(F.struct(*_RULE).alias("rule"), F.explode(_slots(slots)).alias("_slot"))
    forked = transactions.withColumn("_slot", _slot(transactions.columns, slots)).join(rule, "_slot")
    return _keyed(forked, transactions.columns)


# What a rule brings to a transaction.
_RULE = ("rule_id", "grouping_keys", "aggregate_field", "aggregator", "limit_operator", "limit_value", "window_minutes")


def _slots(slots: int) -> Column:
    return F.sequence(F.lit(0), F.lit(slots - 1))


def _slot(columns, slots: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def _keyed(forked: DataFrame, columns) -> DataFrame:
    """Transactions with a struct ``rule``: the rule's key, amount and fields."""
    def value_of(name: Column) -> Column:
        """The field of that name as text: only what a rule asks for is worked out."""
        cases = F.when(F.lit(False), F.lit(None).cast("string"))
        for column in columns:
            cases = cases.when(name == column, F.col(column).cast("string"))
        return cases

    key = F.concat(F.lit("{"), F.array_join(F.transform(
        "rule.grouping_keys",
        lambda name: F.concat(name, F.lit("="), F.coalesce(value_of(name), F.lit("null")))),
        ";"), F.lit("}"))
    return forked.withColumns({
        "key": key, "amount": value_of(F.col("rule.aggregate_field")).try_cast(LIMIT_TYPE),
    }).select(
        *columns, "rule.rule_id", "key", "amount", "rule.aggregator",
        "rule.limit_operator", "rule.limit_value", "rule.window_minutes")


def rules_as_of(events: DataFrame, rules: DataFrame, place: str, seq: str = "seq", slots: int = 64) -> DataFrame:
    """``place`` and a struct ``rule``: the usable rules in force at every distinct place of ``events``.

    ``rules`` are all valid ones, with their places in the feed; ``place`` is on the same scale.  In
    force is a rule whose last line up to there is active and came after the last delete-all up to there.

    Two as-of joins over places: the last delete-all, and the last line of each rule id.  Places
    are dealt over ``slots`` and every slot has all rule ids, so nothing depends on how often a rule
    changes, and no transaction is carried along.
    """
    is_control = F.coalesce(F.col("rule_state") == "CONTROL", F.lit(False))
    wipes = rules.filter(is_control & (F.col("control_type") == "DELETE_RULES_ALL")).select(
        F.lit(0).alias("_all"), seq)
    lines = rules.filter(~is_control).select(*_RULE, "rule_state", seq)
    places = events.select(F.col(place).cast("bigint").alias(place)).dropna().distinct().withColumn("_all", F.lit(0))
    wiped = as_of_join(places, wipes, ["_all"], place, seq, into="_wipe").select(
        place, F.col("_wipe")[seq].alias("_wiped"), _slot([place], slots).alias("_slot"))
    ids = lines.select("rule_id").dropna().distinct().withColumn("_slot", F.explode(_slots(slots)))
    found = as_of_join(wiped.join(ids, "_slot").drop("_slot"), lines, ["rule_id"], place, seq, into="_line")
    told = found.filter(F.coalesce(F.col("_line")[seq] > F.col("_wiped"), F.col("_wiped").isNull())).select(
        place, "rule_id", "_line.*")
    told = told.filter(F.col("rule_state") == "ACTIVE").filter(_unusable().isNull())
    return told.select(place, F.struct(*_RULE).alias("rule"))


def fan_out_as_of(transactions: DataFrame, rules: DataFrame, place: str, seq: str = "seq",
                  slots: int = 64) -> DataFrame:
    """Every transaction once per usable rule in force at its ``place``, as `fan_out` gives it.

    A transaction keeps the rules it met: what is added, changed, paused or deleted later
    counts for later ones only.  Transactions without place meet no rule.
    """
    told = rules_as_of(transactions, rules, place, seq, slots).withColumnRenamed(place, "_place")
    forked = transactions.join(told, F.col(place) == F.col("_place")).drop("_place")
    return _keyed(forked, transactions.columns)


# ---- thresholds -----------------------------------------------------------------------

def exceeds(value: Column) -> Column:
    """Does the value stand in the rule's relation to its limit?"""
    limit, operator = F.col("limit_value"), F.col("limit_operator")
    return (F.when(operator == "EQUAL", value == limit)
             .when(operator == "NOT_EQUAL", value != limit)
             .when(operator == "GREATER", value > limit)
             .when(operator == "LESS", value < limit)
             .when(operator == "GREATER_EQUAL", value >= limit)
             .when(operator == "LESS_EQUAL", value <= limit))


def rule_value(total: Column, count: Column, low: Column, high: Column) -> Column:
    aggregator = F.col("aggregator")
    return (F.when(aggregator == "SUM", total.cast(LIMIT_TYPE))
             .when(aggregator == "AVG", (total / count).cast(LIMIT_TYPE))
             .when(aggregator == "MIN", low).when(aggregator == "MAX", high))


def _merged(prefix: str, window) -> dict[str, Column]:
    return {prefix + "sum": F.sum("_sum").over(window), prefix + "n": F.sum("_n").over(window),
            prefix + "low": F.min("_low").over(window), prefix + "high": F.max("_high").over(window)}


# What a rule asks for; every row of a rule says the same.
_ASKED = ("aggregator", "limit_operator", "limit_value", "window_minutes")
# Moments of one key and block that are ordered in one task.
PART_ROWS = 100_000


def moments(fanned: DataFrame, ts: str = "eventTime") -> DataFrame:
    """One row per rule, key and time: sum, count, minimum and maximum of the amounts.

    Time and amounts are all that windows need; the transactions stay behind.  What a rule asks for
    is grouped by, since text among the aggregates makes Spark sort every row.
    """
    amount = F.col("amount")
    told = fanned.groupBy("rule_id", "key", F.col(ts).alias("_ts"), *_ASKED).agg(
        F.sum(amount).cast(LIMIT_TYPE).alias("_sum"), F.count(amount).alias("_n"), F.min(amount).alias("_low"),
        F.max(amount).alias("_high"))
    return told.select("rule_id", "key", "_ts", "_sum", "_n", "_low", "_high", *_ASKED)


def alerting_moments(told: DataFrame, since: int | None = None, parts: int | None = None) -> DataFrame:
    """rule_id, key, _ts, value: the moments whose aggregate over ``[_ts - window, _ts]`` meets
    the limit; of those after ``since`` if given, the others only add to their windows.

    Time is cut into blocks as long as the rule's window.  A window is then the head of its
    own block and the tail of the block before, and both are running aggregates: work is
    linear and windows of any length share one plan.  Blocks are cut into panes again: what
    runs inside a pane is ordered there, and what comes before or after it in the block is a
    running aggregate of the panes' totals.  So a key is never brought together beyond one
    pane, not even the empty key of a rule without names.  ``told`` should be a written table:
    blocks are counted first, and a rule's are cut into so many panes that its largest fits; most
    fit as they are and have nothing around them.
    """
    length = F.col("window_minutes").cast("bigint") * 60_000
    span = F.greatest(length, F.lit(1))
    # Rows carry only what their rule's aggregate is made of.
    made_of = {"_sum": ("SUM", "AVG"), "_low": ("MIN",), "_high": ("MAX",)}
    needed = {name: F.when(F.col("aggregator").isin(*of), F.col(name)) for name, of in made_of.items()}
    blocked = (told.withColumns({"_span": span, "_length": length, **needed})
               .withColumn("_block", F.call_function("div", F.col("_ts") - F.pmod(F.col("_ts"), F.col("_span")), F.col("_span"))))
    # What a rule asks for and its panes are told once per rule.
    largest = blocked.groupBy("rule_id", *_ASKED, "key", "_block").count().groupBy("rule_id", *_ASKED).agg(
        F.max("count").alias("_most"))
    panes = (F.when(F.col("_most") <= PART_ROWS, 1).otherwise(F.ceil(F.col("_most") / PART_ROWS) * 2) if parts is None
             else F.lit(parts))
    asked = stored(largest.select("rule_id", *_ASKED, panes.cast("bigint").alias("_parts")), "rule-panes")
    cut = (asked.agg(F.max("_parts")).first()[0] or 1) > 1
    blocked = blocked.join(asked.select("rule_id", "_parts"), "rule_id")

    # Each moment is seen twice: as data of its block, and as a question put to the block
    # before, at the place where its window starts.
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (
        ("_sum", LIMIT_TYPE), ("_n", "bigint"), ("_low", LIMIT_TYPE), ("_high", LIMIT_TYPE))]
    asks = F.lit(True) if since is None else F.col("_ts") > since
    seen = F.struct(F.col("_block").alias("_at"), F.col("_ts").alias("_place"), "_sum", "_n", "_low", "_high",
                    F.lit(None).cast("bigint").alias("_of"))
    question = F.struct((F.col("_block") - 1).alias("_at"), (F.col("_ts") - F.col("_length")).alias("_place"),
                        *none, F.col("_ts").alias("_of"))
    narrow = blocked.select("rule_id", "key", "_span", "_parts", F.inline(
        F.when(asks, F.array(seen, question)).otherwise(F.array(seen))))
    narrow = narrow.withColumn("_part", F.call_function(
        "div", (F.col("_place") - F.col("_at") * F.col("_span")) * F.col("_parts"), F.col("_span")))

    group = ["rule_id", "key", "_at"]
    inside = Window.partitionBy(*group, "_part")
    head = inside.orderBy("_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = inside.orderBy(F.col("_place").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ran = narrow.drop("_span", "_parts").withColumns(_merged("_h_", head) | _merged("_t_", tail))
    if cut:
        totals = narrow.filter("_parts > 1").groupBy(*group, "_part").agg(
            F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"),
            F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        across = Window.partitionBy(*group)
        before = across.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        after = across.orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
        around = totals.withColumns(_merged("_b_", before) | _merged("_a_", after)).drop("_sum", "_n", "_low", "_high")
        ran = ran.join(around, [*group, "_part"], "left")

    def sides(own: str, beside: str) -> Column:
        zero = F.lit(0)
        if not cut:
            return F.struct(F.coalesce(own + "sum", zero).cast(LIMIT_TYPE).alias("s"), F.coalesce(own + "n", zero).alias("n"),
                            F.col(own + "low").alias("low"), F.col(own + "high").alias("high"))
        return F.struct((F.coalesce(own + "sum", zero) + F.coalesce(beside + "sum", zero)).cast(LIMIT_TYPE).alias("s"),
                        (F.coalesce(own + "n", zero) + F.coalesce(beside + "n", zero)).alias("n"),
                        F.least(own + "low", beside + "low").alias("low"), F.greatest(own + "high", beside + "high").alias("high"))

    half = F.when(F.col("_of").isNull(), sides("_h_", "_b_")).otherwise(sides("_t_", "_a_"))
    windows = (ran.select("rule_id", "key", F.coalesce("_of", "_place").alias("_ts"), half.alias("_half"))
               .groupBy("_ts", "rule_id", "key").agg(
                   F.sum("_half.s").alias("s"), F.sum("_half.n").alias("n"), F.min("_half.low").alias("low"),
                   F.max("_half.high").alias("high")))
    if since is not None:
        windows = windows.filter(F.col("_ts") > since)
    value = rule_value(F.col("s"), F.col("n"), F.col("low"), F.col("high"))
    return (windows.join(asked.drop("_parts"), "rule_id").withColumn("value", F.when(F.col("n") > 0, value)).filter(exceeds(F.col("value")))
            .select("rule_id", "key", "_ts", "value"))


def alerted(fanned: DataFrame, alerting: DataFrame, ts: str = "eventTime") -> DataFrame:
    """The transactions of the alerting moments, with the value that alerts."""
    found = fanned.withColumn("_ts", F.col(ts)).join(alerting, ["_ts", "rule_id", "key"])
    return found.select(*[name for name in fanned.columns if name != "amount"], "value")


# Rows of one key and block that one task goes through, blocks that go to a task together, and counts
# that tell how long the longest block may be.
BLOCK_ROWS, RUN_BLOCKS, COUNTERS = 1_000_000, 16, 1 << 16


def _blocked(fanned: DataFrame, ts: str) -> DataFrame:
    """Rows that have a moment, a key and a rule, with the block of time as long as the rule's window."""
    span = F.greatest(F.col("window_minutes").cast("bigint") * 60_000, F.lit(1))
    told = fanned.filter(F.col(ts).isNotNull() & F.col("rule_id").isNotNull() & F.col("key").isNotNull())
    return told.withColumn("_ts", F.col(ts).cast("bigint")).withColumn("_span", span).withColumn(
        "_block", F.call_function("div", F.col("_ts") - F.pmod("_ts", "_span"), F.col("_span")))


def long_blocks(fanned: DataFrame, ts: str = "eventTime") -> list[int]:
    """Rules that may have a block of over ``BLOCK_ROWS`` rows.

    Blocks share counters by hash, so what is counted is never less than a block, and what
    is shuffled does not grow with the keys.  One number a rule is read on the driver.
    """
    slot = F.pmod(F.xxhash64("key", "_block"), F.lit(COUNTERS)).alias("_slot")
    counts = _blocked(fanned, ts).groupBy("rule_id", slot).count().groupBy("rule_id").agg(F.max("count").alias("most"))
    return sorted(r.rule_id for r in counts.filter(F.col("most") > BLOCK_ROWS).toLocalIterator())


def alerts_in_runs(fanned: DataFrame, ts: str = "eventTime") -> DataFrame:
    """The alerts of `rule_alerts`, of rules whose blocks fit a task: rows are dealt out once, by rule, key and
    run of ``RUN_BLOCKS`` blocks.

    A window is the head of its own block and the tail of the block before.  So every row counts in
    two pairs of blocks: in the pair that ends with its block it asks, in the next it only adds.
    Inside a pair both are running aggregates, by the place in the block.  A row of the last block
    of a run goes to the next run too, to add there.
    """
    length, plain = F.col("window_minutes").cast("bigint") * 60_000, fanned.columns
    run = lambda block: F.call_function("div", block - F.pmod(block, F.lit(RUN_BLOCKS)), F.lit(RUN_BLOCKS))
    own, after = run(F.col("_block")), run(F.col("_block") + 1)
    dealt = _blocked(fanned, ts).select(*plain, "_ts", F.explode(
        F.when(own == after, F.array(own)).otherwise(F.array(own, after))).alias("_run"))
    dealt = _blocked(dealt.repartition("rule_id", "key", "_run").drop("_ts"), ts)
    asks, adds = F.struct(F.col("_block").alias("_pair"), F.lit(True).alias("_asks")), F.struct(
        (F.col("_block") + 1).alias("_pair"), F.lit(False).alias("_asks"))
    paired = dealt.select("*", F.inline(F.when(own == after, F.array(asks, adds)).otherwise(
        F.when(own == F.col("_run"), F.array(asks)).otherwise(F.array(adds)))))
    place = F.col("_ts") - F.col("_block") * F.col("_span")
    paired = paired.withColumns({
        # A window of 0 is the moment itself: nothing of the block before.
        "_head": place, "_tail": F.when(F.col("_asks"), place + F.col("_span") - length).otherwise(place),
        "_h": F.when(F.col("_asks"), F.col("amount")), "_t": F.when(~F.col("_asks"), F.col("amount"))})

    pair = Window.partitionBy("rule_id", "key", "_run", "_pair")
    head = pair.orderBy("_head").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = pair.orderBy(F.col("_tail").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ran = paired.withColumns({name + of: value for name, window in (("_h", head), ("_t", tail)) for of, value in (
        ("_sum", F.sum(name).over(window)), ("_n", F.count(name).over(window)), ("_low", F.min(name).over(window)),
        ("_high", F.max(name).over(window)))}).filter("_asks")
    zero, n = F.lit(0).cast("decimal(38,4)"), F.col("_h_n") + F.col("_t_n")
    total = (F.coalesce("_h_sum", zero) + F.coalesce("_t_sum", zero)).cast("decimal(38,4)")
    value = rule_value(total, n, F.least("_h_low", "_t_low"), F.greatest("_h_high", "_t_high"))
    return ran.withColumn("value", F.when(n > 0, value)).filter(exceeds(F.col("value"))).select(
        *[name for name in plain if name != "amount"], "value")


def rule_alerts(fanned: DataFrame, ts: str = "eventTime", parts: int | None = None) -> DataFrame:
    """Transactions whose rule aggregate over ``[ts - window, ts]`` meets the limit.

    Blocks that fit a task are answered row by row.  Rules that may have longer ones, all with ``parts``,
    write their moments once; windows are judged on them, cut into panes, and only the alerting ones are
    joined with the transactions.
    """
    long = long_blocks(fanned, ts) if parts is None else []
    if parts is None and not long:
        return alerts_in_runs(fanned, ts)
    cut = fanned.filter(F.col("rule_id").isin(long)) if parts is None else fanned
    told = stored(moments(cut, ts), "rule-moments")
    alerts = alerted(cut, alerting_moments(told, parts=parts), ts)
    return alerts if parts is not None else alerts.unionByName(
        alerts_in_runs(fanned.filter(~F.col("rule_id").isin(long)), ts))
