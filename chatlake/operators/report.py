"""Report queries over the curated table: filters, aggregations, sorted lists.

Every visual of the two report pages is one DataFrame query here. All filters
are predicates on raw curated columns, so against a parquet table they reach
the scan (PushedFilters / row-group skipping). Aggregations are exact and run
partial-then-final; distinct counts per group first de-duplicate on
(group, id), so a group holding a third of all rows is spread over many tasks
before its single count is combined.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace
from collections.abc import Callable, Mapping
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGENT = "bot_conversationtranscriptidname"
CHANNEL = "channelId"
DATE = "conversation_startdate"
START = "conversation_starttime"
PART_START = "conversation_part_starttime"

# Short names accepted by the filter helpers.
FIELD_ALIASES = {"agent": AGENT, "channel": CHANNEL, "date": DATE, "start": START}


def _col_name(name: str) -> str:
    return FIELD_ALIASES.get(name, name)


def _as_date(value: dt.date | str) -> Column:
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(value))


def _literal(value: Any) -> Column:
    """A literal; naive datetimes become TIMESTAMP_NTZ (the curated time type), so the
    comparison does not go through the session time zone."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


# ---- filters ---------------------------------------------------------------


def agent_in(agents: Iterable[str]) -> Column:
    """Drill-through / page filter: agent IN (values)."""
    return F.col(AGENT).isin(list(agents))


def date_between(start: dt.date | str | None = None, end: dt.date | str | None = None) -> Column | None:
    """Inclusive day range on the start date; the end is applied as ``< end + 1 day``."""
    preds = []
    if start is not None:
        preds.append(F.col(DATE) >= _as_date(start))
    if end is not None:
        preds.append(F.col(DATE) < F.date_add(_as_date(end), 1))
    if not preds:
        return None
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def not_in_keep_null(column: str, values: Iterable[Any]) -> Column:
    """Inverted selection: everything except ``values``; blank (NULL) rows stay.

    Plain SQL ``NOT IN`` would drop NULLs (``NULL NOT IN (...)`` is NULL).
    """
    c = F.col(_col_name(column))
    return c.isNull() | ~c.isin(list(values))


def by_agent(curated: DataFrame, agents: Iterable[str]) -> DataFrame:
    return curated.where(agent_in(agents))


def by_date(curated: DataFrame, start: dt.date | str | None = None, end: dt.date | str | None = None) -> DataFrame:
    pred = date_between(start, end)
    return curated if pred is None else curated.where(pred)


def excluding(curated: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    return curated.where(not_in_keep_null(column, values))


@dataclass(frozen=True)
class ReportFilter:
    """One filter state shared by every visual of both pages.

    ``agents``: drill-through agent list (IN). ``date_start``/``date_end``:
    inclusive start-date range. ``exclude_agents``/``exclude_channels``:
    inverted dropdown selections (NULLs kept). ``selection``: cross-filter picks
    as (column, value) or (column, value, visual): an equality (e.g. a start time
    picked in the conversation list, or a bar's agent) and the visual in which
    it was picked, which the pick does not filter.
    """

    agents: tuple[str, ...] | None = None
    date_start: dt.date | str | None = None
    date_end: dt.date | str | None = None
    exclude_agents: tuple[str, ...] = ()
    exclude_channels: tuple[str, ...] = ()
    selection: tuple[tuple, ...] = field(default_factory=tuple)

    def predicate(self, visual: str | None = None) -> Column | None:
        """The filter as ``visual`` sees it (None: as a visual in which nothing was picked)."""
        preds: list[Column] = []
        if self.agents is not None:
            preds.append(agent_in(self.agents))
        d = date_between(self.date_start, self.date_end)
        if d is not None:
            preds.append(d)
        if self.exclude_agents:
            preds.append(not_in_keep_null(AGENT, self.exclude_agents))
        if self.exclude_channels:
            preds.append(not_in_keep_null(CHANNEL, self.exclude_channels))
        for name, value, *origin in self.selection:
            if visual is not None and origin == [visual]:
                continue
            c = F.col(_col_name(name))
            preds.append(c.isNull() if value is None else c == _literal(value))
        if not preds:
            return None
        out = preds[0]
        for p in preds[1:]:
            out = out & p
        return out

    def predicate_without_picks(self) -> Column | None:
        """What all visuals have in common."""
        return replace(self, selection=()).predicate()

    def apply(self, curated: DataFrame, visual: str | None = None) -> DataFrame:
        pred = self.predicate(visual)
        return curated if pred is None else curated.where(pred)


# ---- aggregations ----------------------------------------------------------


def distinct_ids(blank_as_value: bool = False) -> Column:
    """Distinct conversation ids. Spark's count skips a NULL id; the source
    report's distinct count counts a blank id as one more value, which
    ``blank_as_value=True`` reproduces: a struct holding a NULL is itself a
    non-NULL value, so it is counted once, and the query keeps a single distinct
    aggregate (no row expansion). Ids are transcript keys, so they are not NULL
    in practice and both give the same number."""
    return F.count_distinct(F.struct("id") if blank_as_value else F.col("id"))


def total_conversations(curated: DataFrame, blank_as_value: bool = False) -> DataFrame:
    """Distinct conversation ids (one row)."""
    return curated.agg(distinct_ids(blank_as_value).alias("total_conversations"))


def _distinct_by(curated: DataFrame, key: str, blank_as_value: bool = False) -> DataFrame:
    return (
        curated.groupBy(key)
        .agg(distinct_ids(blank_as_value).alias("conversations"))
        .orderBy(F.col("conversations").desc(), F.col(key).asc_nulls_last())
    )


def conversations_by_agent(curated: DataFrame, blank_as_value: bool = False) -> DataFrame:
    """Bars: distinct conversations per agent, largest first (agent name breaks ties)."""
    return _distinct_by(curated, AGENT, blank_as_value)


def conversations_by_channel(curated: DataFrame, blank_as_value: bool = False) -> DataFrame:
    """Bars: distinct conversations per channel, largest first."""
    return _distinct_by(curated, CHANNEL, blank_as_value)


def messages_by_date_agent(curated: DataFrame) -> DataFrame:
    """Columns per start date and agent: non-null ids, i.e. messages (the source
    chart labels this "conversations")."""
    return (
        curated.groupBy(DATE, AGENT)
        .agg(F.count("id").alias("messages"))
        .orderBy(DATE, AGENT)
    )


def conversations_by_date_agent(curated: DataFrame) -> DataFrame:
    """Distinct conversations per start date and agent."""
    return (
        curated.groupBy(DATE, AGENT)
        .agg(F.count_distinct("id").alias("conversations"))
        .orderBy(DATE, AGENT)
    )


def agent_header(curated: DataFrame) -> DataFrame:
    """Page header: the first agent name in sort order (one row)."""
    return curated.agg(F.min(AGENT).alias("agent"))


def conversation_list(curated: DataFrame) -> DataFrame:
    """Distinct conversation start times, newest first.

    Many messages share one start time, so the distinct runs with map-side
    pre-aggregation before the sort's range shuffle.
    """
    return curated.select(START).distinct().orderBy(F.col(START).desc())


MESSAGE_LIST_COLUMNS = [PART_START, CHANNEL, "icon", "from", "text"]


def message_list(curated: DataFrame) -> DataFrame:
    """Distinct (time, channel, icon, sender, text) rows with text, oldest first.

    Skew-safe at scale: the distinct pre-aggregates map-side (a hot duplicate
    row collapses before the shuffle) and shuffles on all five columns; the
    sort then range-partitions on (time, hash of the other columns), so one
    instant (or the NULL time of messages without a timestamp) holding a third
    of all rows is still split over many tasks. The hash keeps the range
    sampler's driver-side sample small (no message text in the sort key).
    """
    rows = curated.where(F.col("text").isNotNull()).select(
        PART_START, CHANNEL, F.col("from_icon").alias("icon"), "from", "text"
    )
    tiebreak = F.xxhash64(CHANNEL, "icon", "from", "text")
    return rows.distinct().orderBy(F.col(PART_START).asc(), tiebreak.asc())


def filter_domain_agents(curated: DataFrame) -> DataFrame:
    return curated.select(AGENT).distinct().orderBy(F.col(AGENT).asc())


def filter_domain_channels(curated: DataFrame) -> DataFrame:
    return curated.select(CHANNEL).distinct().orderBy(F.col(CHANNEL).asc())


def filter_domain_dates(curated: DataFrame) -> DataFrame:
    return curated.agg(F.min(DATE).alias("date_min"), F.max(DATE).alias("date_max"))


def filter_domains_long(curated: DataFrame) -> DataFrame:
    """All slicer domains in one table: (domain, value) rows for every agent, every
    channel, and the first and last start date (as ISO text)."""
    agents = filter_domain_agents(curated).select(F.lit("agent").alias("domain"), F.col(AGENT).alias("value"))
    channels = filter_domain_channels(curated).select(F.lit("channel").alias("domain"), F.col(CHANNEL).alias("value"))
    dates = filter_domain_dates(curated).select(
        F.explode(
            F.array(
                F.struct(F.lit("date_min").alias("domain"), F.col("date_min").cast("string").alias("value")),
                F.struct(F.lit("date_max").alias("domain"), F.col("date_max").cast("string").alias("value")),
            )
        ).alias("d")
    ).select("d.*")
    return agents.unionByName(channels).unionByName(dates)


def filter_domains(curated: DataFrame) -> dict[str, DataFrame]:
    """Values offered by the agent and channel dropdowns and the date slicer."""
    return {
        "agents": filter_domain_agents(curated),
        "channels": filter_domain_channels(curated),
        "dates": filter_domain_dates(curated),
    }


# ---- pages -----------------------------------------------------------------


class Page(Mapping):
    """The visuals of one report page, each built on first access.

    Building a DataFrame costs JVM round trips; a caller that shows one visual
    should not pay for the other three.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def summary_page(curated: DataFrame, flt: ReportFilter = ReportFilter()) -> Page:
    """Summary page: one filter state, four visuals."""
    visuals = {
        "total_conversations": total_conversations,
        "conversations_by_agent": conversations_by_agent,
        "conversations_by_channel": conversations_by_channel,
        "messages_by_date_agent": messages_by_date_agent,
    }
    return Page({name: (lambda n=name, v=visual: v(flt.apply(curated, n))) for name, visual in visuals.items()})


def detail_page(curated: DataFrame, agent: str | Iterable[str], flt: ReportFilter = ReportFilter()) -> Page:
    """Detail page: drill-through agent(s) plus the shared filter state."""
    agents = (agent,) if isinstance(agent, str) else tuple(agent)
    visuals = {
        "total_conversations": total_conversations,
        "agent_header": agent_header,
        "conversation_list": conversation_list,
        "message_list": message_list,
    }
    return Page(
        {name: (lambda n=name, v=visual: v(by_agent(flt.apply(curated, n), agents))) for name, visual in visuals.items()}
    )


# ---- pages in one scan -------------------------------------------------------

#: Key columns of a long-form page: those a visual does not group by are NULL.
LONG_KEYS = [DATE, AGENT, CHANNEL, START]
_SUMMARY_KEYS = {
    "total_conversations": [],
    "conversations_by_agent": [AGENT],
    "conversations_by_channel": [CHANNEL],
    "messages_by_date_agent": [DATE, AGENT],
}
_DETAIL_KEYS = {"total_conversations": [], "agent_header": [], "conversation_list": [START]}
#: What a visual shows besides its keys; other visuals show distinct conversations.
_MESSAGES, _HEADER, _LIST = "messages_by_date_agent", "agent_header", "conversation_list"


def _page_long(curated: DataFrame, flt: ReportFilter, visuals: dict[str, list[str]]) -> DataFrame:
    """(visual, the keys, value) of several visuals, from one scan of the curated table.

    A row is dealt to the visuals whose filter it passes (filters differ in picks only), under
    the keys of each. Rows of a visual, its keys and an id are counted first, so a large group is
    spread over many tasks; then ids and their counts are combined per group. A page without rows still has its totals.
    """
    types = {f.name: f.dataType for f in curated.schema.fields}
    shared = flt.predicate_without_picks()
    rows = curated if shared is None else curated.where(shared)
    branches = []
    for name, keys in visuals.items():
        pred = flt.predicate(name)
        fields = [F.lit(name).alias("visual")]
        fields += [(F.col(k) if k in keys else F.lit(None).cast(types[k])).alias(k) for k in LONG_KEYS]
        fields.append((F.col(AGENT) if name == _HEADER else F.lit(None).cast("string")).alias("shown"))
        fields.append((F.col("id") if name not in (_HEADER, _LIST) else F.lit(None).cast("string")).alias("id"))
        branches.append(F.struct(*fields) if pred is None else F.when(pred, F.struct(*fields)))
    dealt = rows.select(F.explode(F.array(*branches)).alias("v")).where("v IS NOT NULL").select("v.*", F.lit(1).alias("row"))
    always = [n for n, keys in visuals.items() if not keys]
    empty = curated.sparkSession.createDataFrame([(n, *[None] * 6, 0) for n in always], dealt.schema)
    each = dealt.unionByName(empty).groupBy("visual", *LONG_KEYS, "id").agg(
        F.count_if(F.col("row") == 1).alias("n"), F.min("shown").alias("shown")
    )
    ids = F.count("id")
    messages = F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0).cast("long"))
    value = (
        F.when(F.col("visual") == _MESSAGES, messages).when(~F.col("visual").isin(_HEADER, _LIST), ids).alias("value")
    )
    out = each.groupBy("visual", *LONG_KEYS).agg(value, F.min("shown").alias("shown"))
    agent = F.coalesce(AGENT, "shown").alias(AGENT)
    return out.select("visual", *[agent if k == AGENT else k for k in LONG_KEYS], "value")


def summary_page_long(curated: DataFrame, flt: ReportFilter = ReportFilter()) -> DataFrame:
    """The four visuals of the summary page in long form."""
    return _page_long(curated, flt, _SUMMARY_KEYS)


def detail_page_long(curated: DataFrame, agent: str | Iterable[str], flt: ReportFilter = ReportFilter()) -> DataFrame:
    """Total, header and conversation list of the detail page in long form (its message list is no aggregate)."""
    agents = (agent,) if isinstance(agent, str) else tuple(agent)
    return _page_long(by_agent(curated, agents), flt, _DETAIL_KEYS)
