"""Trial metrics, strict totals, paired differences, coverage and acceptance: missing is never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a shell command that reads or searches files.
SHELL_READ = r"(?:^|&&|\||;)\s*(?:cat|sed|head|tail|nl|rg|grep)\b"


def strict_sum(value: Column) -> Column:
    """The sum if there are rows and each has a value, else null."""
    return F.when((F.count(value) == F.count("*")) & (F.count("*") > 0), F.sum(value))


def ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def pair_actions(events: DataFrame, keys: list[str]) -> DataFrame:
    """Observations with the last action of their tool_call_id."""
    last = events.where("kind = 'ActionEvent'").groupBy(*keys, "tool_call_id").agg(F.max_by(F.struct("tool_name", "command"), "seq").alias("action"))
    return events.where("kind = 'ObservationEvent'").join(last, [*keys, "tool_call_id"])


def measure(events: DataFrame, responses: DataFrame, keys: list[str]) -> DataFrame:
    """Costs by trial. events: kind, seq, tool_name, command, tool_call_id, content, thought; responses: prompt_tokens, completion_tokens, reasoning."""
    view = (F.col("tool_name") == "file_editor") & (F.col("command") == "view")
    shell = (F.col("tool_name") == "terminal") & F.col("command").rlike(SHELL_READ)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    a = events.where("kind = 'ActionEvent'").groupBy(*keys).agg(
        F.count("*").alias("raw_action_count"), count(~F.col("tool_name").isin("think", "finish")).alias("tool_calls"), count(view).alias("file_view_calls"), count(shell).alias("shell_read_or_search_calls"), count(F.col("tool_name") == "think").alias("think_tool_calls"),
        F.sum(F.when(F.col("thought") != "", F.length("thought"))).alias("visible_thought_chars"))
    is_view = (F.col("action.tool_name") == "file_editor") & (F.col("action.command") == "view")
    is_shell = (F.col("action.tool_name") == "terminal") & F.col("action.command").rlike(SHELL_READ)
    o = pair_actions(events, keys).groupBy(*keys).agg(F.sum(F.when(is_view, F.length("content"))).alias("file_view_chars"), F.sum(F.when(is_shell, F.length("content"))).alias("shell_read_or_search_output_chars"))
    r = responses.groupBy(*keys).agg(
        F.count("*").alias("provider_requests"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"), F.sum(F.length("reasoning")).alias("reasoning_chars"),
        F.bool_and(F.col("prompt_tokens").isNotNull() & F.col("completion_tokens").isNotNull()).alias("usage_complete"))
    out = a.join(o, keys, "left").join(r, keys, "left")
    zero = ["file_view_chars", "shell_read_or_search_output_chars", "provider_requests", "prompt_tokens", "completion_tokens"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero}).withColumn("usage_complete", F.coalesce("usage_complete", F.lit(False)))
    return out.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))


def pair_trials(trials: DataFrame, task: str, condition: str, without: str, with_: str) -> DataFrame:
    """One row per task that has both conditions; columns a_* and b_*."""
    one = lambda c, p: trials.where(F.col(condition) == c).select(task, *(F.col(x).alias(f"{p}_{x}") for x in trials.columns if x not in (task, condition)))
    return one(without, "a").join(one(with_, "b"), task)


def paired_deltas(trials: DataFrame, task: str, condition: str, without, with_, passed: str, costs: list[str], complete: dict[str, str] | None = None) -> DataFrame:
    """b - a of each cost where both conditions passed and both have a value; for costs in `complete` the named flag must hold too."""
    p = pair_trials(trials, task, condition, without, with_)
    both = F.coalesce(F.col(f"a_{passed}") & F.col(f"b_{passed}"), F.lit(False))
    ok = lambda c: both if c not in (complete or {}) else both & F.coalesce(F.col(f"a_{complete[c]}") & F.col(f"b_{complete[c]}"), F.lit(False))
    return p.select(task, both.alias("both_passed"), (F.coalesce(F.col(f"b_{passed}"), F.lit(False)).cast("int") - F.coalesce(F.col(f"a_{passed}"), F.lit(False)).cast("int")).alias("completion_difference"), *(F.when(ok(c), F.col(f"b_{c}") - F.col(f"a_{c}")).alias(f"{c}_difference") for c in costs))


def pass_rates(trials: DataFrame, group: list[str], condition: str, without, with_, passed: str) -> DataFrame:
    """Share passed by condition (null without trials) and with minus without."""
    rate = lambda c: F.avg(F.when(F.col(condition) == c, F.col(passed).cast("int")))
    n = lambda c: F.count_if(F.col(condition) == c)
    out = trials.groupBy(*group).agg(n(without).alias("n_without"), n(with_).alias("n_with"), rate(without).alias("rate_without"), rate(with_).alias("rate_with"))
    return out.withColumn("difference", F.col("rate_with") - F.col("rate_without"))


def usage_summary(rows: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    out = [F.count("*").alias("n")]
    for v in values:
        out += [F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max"), F.round(F.avg(v), 3).alias(f"{v}_mean"), F.round(F.median(v), 3).alias(f"{v}_median")]
    return rows.groupBy(*group).agg(*out)


def coverage(sources: DataFrame, facts: DataFrame, grouped: DataFrame, keys: list[str]) -> DataFrame:
    """Eligible sources (keys, source, in_scope), those cited by facts (keys, fact, source) and those in groups (keys, source); ratios are null without eligible ones."""
    mark = lambda df, n: df.select(*keys, "source").distinct().withColumn(n, F.lit(True))
    s = sources.join(mark(facts, "cited"), [*keys, "source"], "left").join(mark(grouped, "grouped"), [*keys, "source"], "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    g = s.groupBy(*keys).agg(F.count_distinct("source").alias("eligible_sources"), F.count_distinct(F.when(has("in_scope"), F.col("source"))).alias("scoped_sources"), F.count_distinct(F.when(has("cited"), F.col("source"))).alias("cited_sources"), F.count_distinct(F.when(has("grouped"), F.col("source"))).alias("grouped_sources"))
    n = facts.groupBy(*keys).agg(F.count_distinct("fact").alias("facts"))
    return g.join(n, keys, "left").select(*g.columns, F.coalesce("facts", F.lit(0)).alias("facts"), ratio(F.col("cited_sources"), F.col("eligible_sources")).alias("cited_ratio"), ratio(F.col("grouped_sources"), F.col("eligible_sources")).alias("grouped_ratio"))


def assess_acceptance(items: DataFrame, cases: DataFrame, run_status: str) -> DataFrame:
    """items (id, tests array) with status: failed if any named case failed, passed if each test has exactly one case and it passed, else uncertain."""
    t = items.select("id", F.explode_outer("tests").alias("test"))
    c = cases.groupBy(F.col("id").alias("test")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "passed").alias("passed"), F.count_if(F.col("status") == "failed").alias("failed"))
    j = t.join(c, "test", "left").groupBy("id").agg(F.count("test").alias("named"), F.bool_or(F.coalesce(F.col("failed") > 0, F.lit(False))).alias("bad"), F.bool_and(F.coalesce((F.col("n") == 1) & (F.col("passed") == 1), F.lit(False))).alias("good"))
    ran = F.lit(run_status in ("passed", "failed"))
    return j.select("id", F.when((F.col("named") > 0) & F.col("bad"), "failed").when((F.col("named") > 0) & F.col("good") & ran, "passed").otherwise("uncertain").alias("status"))


def acceptance_status(rows: DataFrame, run_status: str) -> DataFrame:
    r = rows.agg(F.count("*").alias("items"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "passed").alias("passed"))
    return r.withColumn("status", F.when((F.lit(run_status) == "failed") | (F.col("failed") > 0), "failed").when((F.col("items") > 0) & (F.col("passed") == F.col("items")) & (F.lit(run_status) != "error"), "passed").otherwise("uncertain"))


def counts_by_state(rows: DataFrame, state: str, states: list[str], keys: list[str] = ()) -> DataFrame:
    """Counts of every listed state, zero where there is none; a null state counts as unknown."""
    return rows.groupBy(*keys).agg(*(F.count_if(F.coalesce(F.col(state), F.lit("unknown")) == s).alias(s) for s in states))


def run_status(approved: Column, review: Column, rejected: Column, errors: Column, enabled: Column, networked: Column) -> Column:
    return F.when(~enabled, "disabled").when(~networked, "static_only").when(review > 0, "needs_review").when(approved > 0, "approved").when(errors > 0, "failed").when(rejected > 0, "rejected").otherwise("completed_no_questions")
