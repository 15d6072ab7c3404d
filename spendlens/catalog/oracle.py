"""DuckDB SQL with the same answer as each query, over the driver's views."""

from __future__ import annotations

import numpy as np

from ..functions.text import DEFAULT_CATEGORY, EXPENSE_RULES, SLUG_FROM, SLUG_TO
from ..operators.groups import PROFILE
from ..operators.stats import METRICS
from .queries import RENAMES, YEARS

ENTITY = """entity as (
  select c_custkey as entity_id, c_name as name, c_mktsegment || '-' || r_name as grp, n_name as region
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

EXPENSE = """expense as (
  select *, greatest(amount, 0) as amount_pos, amount < 0 as is_refund,
    case when kind like '%bolt%' or kind like '%rod%' or kind like '%ring%' then 'fasteners'
         when kind like '%gear%' or kind like '%gizmo%' or kind like '%widget%' then 'machines'
         when kind like '%plate%' or kind like '%anvil%' then 'finish' else 'other' end as category
  from (select l_orderkey, l_partkey, l_suppkey, l_linenumber, o_custkey as entity_id,
          cast(year(l_shipdate) as integer) as yr,
          case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as amount,
          lower(p_type || ' ' || p_name) as kind
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey))"""

ITEM = "item as (select o_custkey as entity_id, o_orderkey as item_id, cast(year(o_orderdate) as integer) as yr from orders)"
EVENT = "event as (select user_id as entity_id, event_id, cast(year(ts) as integer) as yr from events)"


def money(expression: str) -> str:
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


CATEGORIES = ["fasteners", "machines", "finish", "other"]
_CATEGORY_SUMS = ", ".join(
    f"coalesce({money(f'''case when category = '{c}' then amount_pos end''')}, 0) as spend_{c}" for c in CATEGORIES
)
SPEND = f"""spend as (
  select entity_id, {money('amount_pos')} as spend_total, {money('amount')} as spend_net,
    count(*) as expense_count, count(*) filter (is_refund) as refund_count, {_CATEGORY_SUMS}
  from expense group by entity_id)"""
COUNTS = """items as (select entity_id, count(*) as item_total from item group by 1),
events_per as (select entity_id, count(*) as event_total from event group by 1)"""

EARTH = "6378.137"
FLAT = "(1 / 298.257223563)"
ROOT = f"sqrt(1 + (1 / pow(1 - {FLAT}, 2) - 1) * (1 - pow(lean, 2)) * pow(sin(start + width * {{}}), 2))"
ROUNDS = 8


def integral(height: str) -> str:
    """Over the arc, in ten places; ``{}`` stands for the root."""
    places = zip(*(v.tolist() for v in np.polynomial.legendre.leggauss(10)))
    return "width * (" + " + ".join(f"{w / 2!r} * {height.format(ROOT.format(f'{(x + 1) / 2!r}'))}" for x, w in places) + ")"


def geodesic(lat: str, lon: str, source: str) -> str:
    """CTEs ending in ``far``: rows of ``source`` plus ``km`` to the reference point, by a fixed number of rounds."""
    ctes = [f"""far0 as (
  select *, turn as lam from (select *, sin(b1) as s1, cos(b1) as c1, sin(b2) as s2, cos(b2) as c2 from (
    select *, atan((1 - {FLAT}) * tan(radians({lat}))) as b1,
      atan((1 - {FLAT}) * tan(radians(cast(-15.7975 as double)))) as b2,
      radians(cast(-47.8919 as double) - {lon}) as turn from {source})))"""]
    for k in range(ROUNDS + 1):
        ctes.append(f"""arc{k} as (
  select * exclude (x, y, z), atan2(sqrt(x * x + y * y), z) as width, c1 * x / sqrt(x * x + y * y) as lean,
    atan2(s1, c1 * y / sqrt(x * x + y * y)) as start
  from (select *, c2 * sin(lam) as x, c1 * s2 - s1 * c2 * cos(lam) as y, s1 * s2 + c1 * c2 * cos(lam) as z from far{k}))""")
        if k < ROUNDS:
            slower = integral(f"(2 - {FLAT}) / (1 + (1 - {FLAT}) * {{}})")
            ctes.append(f"far{k + 1} as (select * exclude (width, lean, start) replace (turn + {FLAT} * lean * {slower} as lam) from arc{k})")
    ctes.append(f"far as (select *, {EARTH} * (1 - {FLAT}) * {integral('{}')} as km from arc{ROUNDS})")
    return ",\n".join(ctes)


CENTROID = """centroid as (
  select n_name as region, cast(-30 as double) + n_nationkey * cast(1.3 as double) as lat,
    cast(-70 as double) + n_nationkey * cast(1.2 as double) as lon from nation)"""

MODEL = f"""{ENTITY}, {EXPENSE}, {ITEM}, {EVENT}, {SPEND}, {COUNTS}, {CENTROID}, {geodesic('lat', 'lon', 'centroid')},
model as (
  select e.entity_id, name, grp, e.region, coalesce(km, 0) as distance_km,
    coalesce(spend_total, 0) as spend_total, coalesce(spend_net, 0) as spend_net,
    coalesce(expense_count, 0) as expense_count, coalesce(refund_count, 0) as refund_count,
    coalesce(item_total, 0) as item_total, coalesce(event_total, 0) as event_total,
    coalesce(item_total, 0) + coalesce(event_total, 0) * cast(0.3 as double) as activity,
    coalesce(spend_total, 0) / (coalesce(km, 0) + 1) as spend_per_km
  from entity e left join far on e.region = far.region left join spend using (entity_id)
    left join items using (entity_id) left join events_per using (entity_id))"""

_CATEGORY_FILL = ", ".join(f"coalesce(spend_{c}, 0) as spend_{c}" for c in CATEGORIES)
MASTER = f"""{ENTITY}, {EXPENSE}, {ITEM}, {EVENT}, {SPEND}, {COUNTS},
joined as (
  select entity_id, name, grp, region, coalesce(spend_total, 0) as spend_total, coalesce(spend_net, 0) as spend_net,
    coalesce(expense_count, 0) as expense_count, coalesce(refund_count, 0) as refund_count,
    {_CATEGORY_FILL}, coalesce(event_total, 0) as event_total, coalesce(item_total, 0) as item_total,
    coalesce(item_total, 0) + coalesce(event_total, 0) * cast(0.3 as double) as activity
  from entity left join spend using (entity_id) left join items using (entity_id)
    left join events_per using (entity_id)),
master as (
  select *, greatest(spend_total, 0) as spend_adjusted, spend_total = 0 and expense_count = 0 as no_expense,
    case when activity = 0 then 0 else greatest(spend_total, 0) / activity end as cost_per_activity,
    ln(1 + greatest(spend_total, 0)) as log_spend
  from joined)"""

MASTER_COLUMNS = (
    "entity_id, name, grp, region, spend_total, spend_net, expense_count, refund_count, "
    + ", ".join(f"spend_{c}" for c in CATEGORIES)
    + ", event_total, item_total, round(activity, 6) as activity, spend_adjusted, no_expense, "
    "round(cost_per_activity, 6) as cost_per_activity"
)
PREPARED_COLUMNS = (
    "entity_id, name, grp, region, spend_total, spend_net, cast(expense_count as double) as expense_count, "
    "cast(refund_count as double) as refund_count, " + ", ".join(f"spend_{c}" for c in CATEGORIES)
    + ", cast(event_total as double) as event_total, cast(item_total as double) as item_total, "
    "round(activity, 6) as activity, spend_adjusted, no_expense, round(cost_per_activity, 6) as cost_per_activity, "
    "round(log_spend, 6) as log_spend"
)

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
SIGNED = "(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end)"


def top_groups(n: int, source: str = "master", value: str = "spend_total") -> str:
    return f"""top as (
  select grp, spend, row_number() over (order by spend desc, grp) as pos
  from (select grp, {money(value)} as spend from {source} group by grp)
  order by pos limit {n})"""


def band(value: str, key: str, source: str) -> str:
    """CTE ``banded``: equal-count bands by rank."""
    return f"""ranked as (
  select *, row_number() over (order by {value}, {key}) as r, count(*) over () as n from {source}),
banded as (
  select *, cast(case when n = 1 then 1 else greatest(1, (4 * (r - 1) + n - 2) // (n - 1)) end as integer) as band_no
  from ranked)"""


BAND_NAME = "case band_no when 1 then 'Baixo' when 2 then 'Médio-baixo' when 3 then 'Médio-alto' else 'Alto' end"

# Cells of the group marts: the expenses of every tenth entity stand once more under an id that no entity has.
CELLS = f"""{ENTITY}, {EXPENSE},
facts as (select * from expense union all
  select * replace (-entity_id - 1 as entity_id) from expense where entity_id % 10 = 3),
labelled as (
  select x.*, coalesce(e.grp, 'Desconhecido') as grp, e.name from facts x left join entity e using (entity_id))"""
PAGE_PARTS = """request_entity, request_year, page, cast(not is_empty as integer) as records,
  case when not is_empty then id end as id, case when not is_empty then total end as total,
  case when not is_empty then status end as status, case when has_next then 'self,next' else 'self' end as rels,
  case when has_next then '/page,/page' else '/page' end as hrefs"""

PAGES = """pages_ as (
  select o_custkey as request_entity, cast(year(o_orderdate) as integer) as request_year,
    row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey) as page,
    o_orderkey as id, o_totalprice as total, o_orderstatus as status,
    o_orderpriority = '1-URGENT' as is_empty, o_orderstatus <> 'F' as has_next
  from orders)"""


def _ingested() -> str:
    """``pages_`` with what is lost or late, and ``settled``: requests that end, their stop page, and the run that has it all."""
    return f"""with {ENTITY}, {PAGES.replace("pages_ as (", "sent as (", 1)},
      pages_ as (select *, request_entity % 3 = 0 and page = 2 as is_late, request_entity % 11 = 0 and page = 1 as lost from sent),
      stops as (select request_entity, request_year, min(page) as stop from pages_ where is_empty and not lost
                group by request_entity, request_year),
      settled as (select request_entity, request_year, stop, cast(max(cast(is_late as integer)) as bigint) as run
                  from pages_ join stops using (request_entity, request_year) where page <= stop
                  group by request_entity, request_year, stop having not bool_or(lost))"""


def stopped(condition: str) -> str:
    return f"""{PAGES}, kept as (
  select p.* from pages_ p where not exists (
    select 1 from pages_ s where s.request_entity = p.request_entity and s.request_year = p.request_year
      and s.page < p.page and ({condition})))"""


DIRTY = """dirty as (
  select *, event_type in ('click', 'signup') as plain from events)"""


def quartile_cte(source: str, metrics: list[str], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    long = " union all ".join(
        f"select {lead}entity_id, '{m}' as metric, cast({m} as double) as value from {source}" for m in metrics
    )
    return f"""long as ({long}),
quart as (
  select {lead}metric, count(*) as n, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
    quantile_cont(value, 0.75) as q3
  from long group by {lead}metric),
fenced as (
  select l.*, n, q1, median, q3,
    value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
  from long l join quart using ({lead}metric))"""


def box(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""select {lead}metric, n, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  round(min(value) filter (inside), 6) as whisker_low, round(max(value) filter (inside), 6) as whisker_high,
  count(*) filter (not inside) as outliers
from fenced group by {lead}metric, n, q1, median, q3"""


_corr_cells = " union all ".join(
    f"select '{a}' as metric_a, '{b}' as metric_b, round(corr({a}, {b}), 6) as r from master"
    for a in METRICS for b in METRICS
)
_profile_means = ", ".join(f"avg({m}) as {m}" for m in METRICS)
MEAN_PROFILE = f"""{MASTER}, {top_groups(12)},
profile as (select grp, {_profile_means} from master where grp in (select grp from top) group by grp)"""
Z = f"""z as (
  select grp, {', '.join(
      f"coalesce(({m} - avg({m}) over ()) / coalesce(nullif(stddev_pop({m}) over (), 0), 1), 0) as {m}_z" for m in METRICS
  )} from profile)"""

_CENTRE = ", ".join(f"avg({m}_z) as {m}_c" for m in METRICS)


def group_medians(renames: dict[str, str], aggregate: str = "quantile_cont({}, 0.5)") -> str:
    renamed = "grp"
    for old, new in renames.items():
        renamed = f"case when grp = '{old}' then '{new}' else {renamed} end"
    cells = ", ".join(f"{aggregate.format(f'cast({m} as double)')} as {m}" for m in PROFILE)
    return f"""{MASTER}, {top_groups(10)},
based as (select * replace ({renamed} as grp) from master where grp in (select grp from top)),
profile as (
  select t.grp, t.pos, p.* exclude (grp) from top t left join (select grp, {cells} from based group by grp) p using (grp)),
shown as (select * from profile where {' + '.join(f'coalesce({m}, 0)' for m in PROFILE)} > 0)"""


def _real_rules() -> str:
    arms = []
    for category, words in EXPENSE_RULES.items():
        test = " or ".join(f"contains(lower(text), '{w}')" for w in words)
        arms.append(f"when {test} then '{category}'")
    return f"case {' '.join(arms)} else '{DEFAULT_CATEGORY}' end"


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


YEAR_TEST = f"yr > {YEARS['after']} and yr < {YEARS['before']}"

SUMMARY = f"""with {MASTER} select count(*) as entities,
        round(avg(spend_total), 6) as spend_mean, round(median(spend_total), 6) as spend_median,
        round(quantile_cont(spend_total, 0.25), 6) as spend_q1, round(quantile_cont(spend_total, 0.75), 6) as spend_q3,
        round(max(spend_total), 6) as spend_max, round(avg(activity), 6) as activity_mean,
        round(median(activity), 6) as activity_median, round(max(activity), 6) as activity_max,
        round(avg(cost_per_activity), 6) as cost_mean, round(median(cost_per_activity), 6) as cost_median,
        round(quantile_cont(cost_per_activity, 0.75), 6) as cost_q3, round(max(cost_per_activity), 6) as cost_max
        from master"""

ORACLE: dict[str, str] = {
    "read_table": "select c_custkey, c_name, c_acctbal from customer",
    "read_preferred": """select o_orderkey, o_custkey, o_orderstatus, kind, true as absent_is_refused
        from orders, unnest(['parquet', 'csv']) as kinds(kind)""",
    "read_csv": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
    "read_optional": "select doc_id, md5(text) as text_md5, lang, true as absent_is_none from documents",
    "write_table": f"with {EXPENSE} select l_orderkey, l_linenumber, l_suppkey, yr, amount from expense",
    "write_report": SUMMARY,
    "flatten_pages": f"""with {PAGES} select request_entity, request_year, page, cast(0 as integer) as pos, id, total, status
        from pages_ where not is_empty""",
    "page_stop": f"with {stopped('s.is_empty')} select {PAGE_PARTS} from kept",
    "page_stop_next": f"with {stopped('s.is_empty or not s.has_next')} select {PAGE_PARTS} from kept",
    "cap_rows": f"""with {PAGES} select request_entity, request_year, id from pages_ where not is_empty
        qualify row_number() over (partition by request_entity, request_year order by page) <= 2""",
    "tag_rows": f"""with {PAGES} select request_entity as entity_id, request_year as yr, id, total, status
        from pages_ where not is_empty""",
    "build_worklist": f"""with {ENTITY} select entity_id, cast(yr as integer) as yr
        from entity, range(1995, 2002) as years(yr)""",
    "pending_work": f"""with {ENTITY}, {ITEM} select entity_id, cast(yr as integer) as yr from entity, range(1995, 2002) as years(yr)
        where (entity_id, yr) not in (select (entity_id, yr) from item)""",
    "merge_batches": """select o_orderkey, o_custkey, o_orderstatus,
        case when o_orderstatus = 'O' then o_totalprice end as o_totalprice,
        case when o_orderstatus <> 'O' then o_orderpriority end as o_orderpriority from orders""",
    "mark_done": f"with {ITEM}, {EVENT} select entity_id, yr from item union select entity_id, yr from event",
    "union_entities": """select s_suppkey as entity_id, s_name as name from supplier union all
        select c_custkey, c_name from customer where c_custkey not in (select s_suppkey from supplier)""",
    "ingest_pages": f"""with {stopped('s.is_empty')}
        select request_entity as entity_id, request_year as yr, id, total, status from kept where not is_empty""",
    "ingest_resumed": f"""{_ingested()}
        select request_entity as entity_id, request_year as yr, id, total, status, run from pages_ join settled
        using (request_entity, request_year) where not is_empty and page < stop""",
    "ingest_done": f"""{_ingested()}
        select request_entity as entity_id, request_year as yr, cast(stop - 1 as bigint) as rows, false as failed, run
        from settled union all select entity_id, 2050, 0, true, 0 from entity where entity_id % 13 = 1""",
    "ingest_ledger": f"""{_ingested()},
        runs as (select cast(unnest([0, 1]) as bigint) as batch),
        landed as (
          select 0 as batch, p.* from pages_ p, unnest(case when request_entity % 5 = 0 then [1, 2] else [1] end) where not is_late and not lost
          union all select 1, p.* from pages_ p where is_late
          union all select 1, p.* from pages_ p where request_entity % 5 = 0 and request_entity % 11 <> 0)
        select batch, (select count(*) from landed l where l.batch = runs.batch) as pages,
          (select count(*) from landed l join settled s using (request_entity, request_year) where l.batch = runs.batch and s.run < l.batch) as late,
          cast(coalesce((select sum(stop - 1) from settled where run = batch), 0) as bigint) as rows,
          (select count(*) from settled where run = batch) + case when batch = 0 then gone else 0 end as done,
          case when batch = 0 then gone else 0 end as failed, cast(0 as bigint) as broken
        from runs, (select count(*) as gone from entity where entity_id % 13 = 1)""",
    "merge_drifting": """select o_orderkey, o_custkey, cast(o_orderkey as varchar) as code, strftime(o_orderdate, '%Y-%m-%d') as day,
          cast(o_custkey as double) as measure, o_custkey as only_old from orders where o_orderstatus = 'O'
        union all select o_orderkey, o_custkey, 'N/' || o_orderkey, strftime(o_orderdate, '%d.%m.%Y'), o_totalprice, null
        from orders where o_orderstatus <> 'O'""",
    "complete_requests": f"""with {PAGES} select distinct request_entity as entity_id, request_year as yr
        from pages_ where is_empty""",
    "resolve_key": """select c_custkey as entity_id, c_name from customer
        union all select s_suppkey, s_name from supplier""",
    "coerce_number": f"""with {DIRTY} select event_id, case when plain then value
        when event_type = 'purchase' then cast(event_id as double) * 100 end as amount from dirty""",
    "coerce_key": "select event_id, user_id as entity_id from events where event_type <> 'error'",
    "coerce_year": """select event_id, cast(case when event_type in ('error', 'view') then null
        when event_type = 'click' then 2024 else year(ts) end as integer) as yr from events""",
    "select_core": f"with {ENTITY} select * from entity",
    "clip_floor": f"select {LINE}, greatest({SIGNED}, 0) as amount_pos from lineitem",
    "flag_refund": f"select {LINE}, {SIGNED} < 0 as is_refund from lineitem",
    "classify_text": """select p_partkey, case when regexp_matches(k, 'bolt|rod|ring') then 'fasteners'
        when regexp_matches(k, 'gear|gizmo|widget') then 'machines'
        when regexp_matches(k, 'plate|anvil') then 'finish' else 'other' end as category
        from (select p_partkey, lower(p_type || ' ' || p_name) as k from part)""",
    "classify_long_text": f"select doc_id, {_real_rules()} as category from documents",
    "slug": f"select doc_id, md5(translate(lower(text), '{SLUG_FROM}', '{SLUG_TO}')) as slug_md5 from documents",
    "parse_money": f"select {LINE}, case when l_returnflag = 'R' then 0 else l_extendedprice end as amount from lineitem",
    "log1p_spend": f"select {LINE}, round(ln(1 + greatest({SIGNED}, 0)), 6) as log_spend from lineitem",
    "null_nonfinite": "select o_orderkey, case when o_orderstatus = 'O' then o_totalprice else 0 end as value from orders",
    "fill_unknown": """select o_orderkey, case when o_orderstatus = 'P' then 'Desconhecido' else o_orderpriority end as label
        from orders""",
    "fill_zero": f"""with {ENTITY}, {EVENT} select entity_id, count(event_id) as event_total, count(event_id) > 0 as has_events
        from entity left join event using (entity_id) group by entity_id""",
    "activity_score": f"with {MODEL} select entity_id, round(activity, 6) as activity from model",
    "cost_per_activity": f"with {MASTER} select entity_id, round(cost_per_activity, 6) as cost_per_activity from master",
    "flag_no_expense": f"""with {ENTITY}, {EXPENSE} select entity_id,
        entity_id not in (select entity_id from expense) as no_expense
        from (select entity_id from entity union all select -entity_id - 1 from entity)""",
    "spend_per_distance": f"with {MODEL} select entity_id, round(spend_per_km, 6) as spend_per_km from model",
    "distance_km": f"""with place as (select c_custkey, cast(-30 as double) + c_nationkey * cast(1.3 as double)
        + c_acctbal / cast(10000 as double) as lat, cast(-70 as double) + c_nationkey * cast(1.2 as double) as lon from customer),
        {geodesic('lat', 'lon', 'place')} select c_custkey, round(km, 6) as km from far""",
    "polygon_centroid": """with place as (select c_custkey, cast(-30 as double) + c_nationkey * cast(1.3 as double)
        + c_acctbal / cast(10000 as double) as lat, cast(-70 as double) + c_nationkey * cast(1.2 as double) as lon,
        cast(2 as double) + abs(c_acctbal) / cast(10000 as double) as w from customer)
        select c_custkey as region,
          round((w * 2 * (lat + 1) - 0.5 * (lat + 0.75) + 2 * (lat + 1.5)) / (w * 2 + 1.5), 6) as lat,
          round((w * 2 * (lon + w / 2) - 0.5 * (lon + 1) + 2 * (lon + 11)) / (w * 2 + 1.5), 6) as lon from place""",
    "read_regions": """with place as (select c_custkey, c_acctbal, cast(-30 as double) + c_nationkey * cast(1.3 as double)
        + c_acctbal / cast(10000 as double) as lat, cast(-70 as double) + c_nationkey * cast(1.2 as double) as lon from customer)
        select cast(c_custkey as varchar) as region, round(lat + 0.5, 6) as lat,
          round(case when c_acctbal > 0 then lon + 1 else (2 * (lon + 1) + (lon + 4.5)) / 3 end, 6) as lon from place""",
    "replace_values": "select o_orderkey, case o_orderstatus when 'P' then 'PENDING' else o_orderstatus end as status from orders",
    "pick_value_column": f"select {LINE}, greatest({SIGNED}, 0) as spend from lineitem",
    "pick_time_column": "select o_orderkey, cast(year(o_orderdate) as integer) as picked from orders",
    "format_amount": """select o_orderkey, case when v >= 1e6 then format('R$ {:.2f}M', v / 1e6)
        when v >= 1e3 then format('{:,}', cast(round_even(v, 0) as bigint)) else format('{:.1f}', v) end as shown
        from (select o_orderkey, o_totalprice * cast(case o_orderstatus when 'O' then 100 when 'P' then 0.001 else 1 end as double) as v
              from orders)""",
    "label_entity": f"with {ENTITY} select entity_id, name || ' (' || grp || ')' as label from entity",
    "cost_per_item_norm": f"with {MODEL} select entity_id, round(spend_per_km / (item_total + 1), 6) as cost_per_item from model",
    "drop_null_key": "select event_id, user_id as entity_id from events where event_type <> 'error'",
    "drop_null_value": "select event_id, value as amount from events where event_type <> 'view'",
    "year_range": f"with {ITEM} select * from item where {YEAR_TEST}",
    "in_top_groups": f"with {MASTER}, {top_groups(5)} select entity_id, grp from master where grp in (select grp from top)",
    "active_only": f"with {MASTER} select entity_id from master where activity > 0",
    "nonnegative_spend": f"with {MASTER} select entity_id, spend_net as spend_total from master where spend_net >= 0",
    "drop_zero_rows": f"with {MASTER} select entity_id from master where event_total + refund_count > 0",
    "attach_metrics": f"""with {ENTITY}, {EXPENSE}, {ITEM}, {EVENT}, {SPEND}, {COUNTS}
        select entity_id, name, grp, region, spend_total, spend_net, expense_count, refund_count, item_total, event_total
        from entity left join spend using (entity_id) left join items using (entity_id)
          left join events_per using (entity_id)""",
    "attach_category_columns": f"with {EXPENSE}, {SPEND} select * from spend",
    "attach_group": f"""with {CELLS} select l_orderkey, l_linenumber, l_suppkey, entity_id, amount, grp, name from labelled""",
    "attach_distance": f"""with {ENTITY}, {CENTROID}, {geodesic('lat', 'lon', 'centroid')}
        select entity_id, round(km, 6) as distance_km from entity join far using (region)
        union all select -entity_id - 1, 0 from entity where entity_id % 10 = 3""",
    "dedup_rows": "select distinct l_partkey, l_returnflag, l_linestatus from lineitem",
    "dedup_first": """select l_orderkey, l_linenumber, l_suppkey, l_extendedprice from lineitem
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_suppkey, l_extendedprice) = 1""",
    "clean_entities": f"""with {ENTITY}, everyone as (select * from entity union all
          select s_suppkey, s_name, 'supplier', 'none' from supplier)
        select * from everyone qualify row_number() over (partition by entity_id order by name, grp, region) = 1""",
    "clean_expenses": """select distinct l_orderkey, l_partkey, l_suppkey, l_linenumber, o_custkey as entity_id,
          cast(year(l_shipdate) as integer) as yr, amount, p_type || ' ' || p_name as kind,
          greatest(amount, 0) as amount_pos, amount < 0 as is_refund
        from (select *, case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as amount from lineitem)
          join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "clean_counts": f"""with {ENTITY}, {EXPENSE},
        sent as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, kind, yr, amount < 0 as twice,
            case when l_linenumber <> 7 then entity_id end as entity_id, case when l_linenumber <> 6 then amount end as amount from expense),
        one as (select distinct * exclude (twice) from sent),
        kept as (select * from one where entity_id is not null and amount is not null)
        select 'read' as counted, (select count(*) + count(*) filter (twice) from sent) as rows
        union all select 'distinct', (select count(*) from one)
        union all select 'keyed', (select count(*) from one where entity_id is not null)
        union all select 'kept', (select count(*) from kept)
        union all select 'entities', (select count(*) from entity)
        union all select 'without_expense', (select count(*) from entity where entity_id not in (select entity_id from kept))
        union all select 'without_distance', 0""",
    "stored_facts": f"""with {ENTITY}, {EXPENSE}, {SPEND} select entity_id, name, grp, region, spend_total, spend_net,
        expense_count, refund_count from entity left join spend using (entity_id)""",
    "clean_items": f"with {EXPENSE} select entity_id, l_orderkey as item_id, min(yr) as yr from expense group by 1, 2",
    "clean_items_collapsed": f"""with {ITEM} select * from item
        qualify row_number() over (partition by entity_id order by item_id, yr) = 1""",
    "clean_events": """select user_id as entity_id, event_id, cast(case when event_type = 'view' then null
        when event_type = 'click' then 2024 else year(ts) end as integer) as yr from events where event_type <> 'error'""",
    "expense_totals": f"""with {EXPENSE}, {SPEND} select entity_id, spend_total, spend_net, expense_count, refund_count from spend""",
    "expense_totals_rows": f"""with {EXPENSE}, {SPEND} select entity_id, spend_total, spend_net, expense_count, refund_count from spend""",
    "count_refunds": f"select count(*) filter ({SIGNED} < 0) as refunds from lineitem",
    "item_counts": f"with {ITEM} select entity_id, count(*) as item_total from item group by 1",
    "event_counts": f"with {EVENT} select entity_id, count(*) as event_total from event group by 1",
    "expense_totals_subcent": f"""with {EXPENSE} select entity_id, {', '.join(
        f"coalesce(cast(sum(cast({a} as decimal(18,2)) * 0.0001) as double), 0) as {s}"
        for a, s in (("amount_pos", "spend_total"), ("amount", "spend_net"))
    )}, count(amount_pos) as expense_count, count(*) filter (where is_refund) as refund_count from expense group by 1""",
    "category_pivot_unlisted": f"""with {EXPENSE} select entity_id, {', '.join(
        f"coalesce({money(f'case when category in ({names}) then amount_pos end')}, 0) as spend_{c}" for c, names in (
            ("fasteners", "'fasteners'"), ("finish", "'finish'"), ("other", "'machines', 'other'"))
    )} from expense group by 1""",
    "category_pivot": f"""with {EXPENSE}, {SPEND} select entity_id, {', '.join(f'spend_{c}' for c in CATEGORIES)} from spend""",
    "modelling_table": f"""with {MODEL} select * replace (round(distance_km, 6) as distance_km, round(activity, 6) as activity,
        round(spend_per_km, 6) as spend_per_km) from model""",
    "master_table": f"with {MASTER} select {MASTER_COLUMNS} from master",
    "prepared_master": f"""with {MASTER}, {band('spend_total', 'entity_id', 'master')}
        select {PREPARED_COLUMNS}, band_no, {BAND_NAME} as spend_band from banded""",
    "category_totals": f"with {EXPENSE} select category, {money('amount_pos')} as spend from expense group by 1",
    "group_totals": f"with {MASTER}, {top_groups(10)} select grp, spend, cast(pos as integer) as pos from top",
    "region_means": f"""with {MASTER} select region, round({money('spend_total')} / count(*), 6) as mean_spend
        from master group by 1 order by 2 desc, 1 limit 15""",
    "region_totals": f"with {MASTER} select region, {money('spend_total')} as spend from master group by 1",
    "group_category_matrix": f"""with {CELLS}, {top_groups(10, 'labelled', 'amount_pos')}
        select grp, {', '.join(f"coalesce({money(f'''case when category = '{c}' then amount_pos end''')}, 0) as {c}" for c in CATEGORIES)}
        from labelled where grp in (select grp from top) group by grp""",
    "group_category_log": f"""with {CELLS}, {top_groups(10, 'labelled', 'amount_pos')},
        cells as (select grp, category, {money('amount_pos')} as spend from labelled group by 1, 2)
        select t.grp, c.category, coalesce(x.spend, 0) as spend, round(ln(1 + coalesce(x.spend, 0)), 6) as log_spend
        from top t cross join unnest({CATEGORIES}) as c(category) left join cells x
          on x.grp = t.grp and x.category = c.category""",
    "entity_category_grid": f"""with {CELLS}, {top_groups(10, 'labelled', 'amount_pos')},
        kept as (select * from labelled where grp in (select grp from top) and name is not null),
        cells as (select grp, name, category, {money('amount_pos')} as spend from kept group by 1, 2, 3)
        select p.grp, p.name, c.category, coalesce(spend, 0) as spend
        from (select distinct grp, name from kept) p cross join (select distinct category from kept) c
          left join cells x on x.grp = p.grp and x.name = p.name and x.category = c.category""",
    "year_group_series": f"""with {CELLS}, ranged as (select * from labelled where {YEAR_TEST}),
        {top_groups(6, 'ranged', 'amount_pos')}
        select grp, yr, {money('amount_pos')} as spend from ranged where grp in (select grp from top) group by 1, 2""",
    "group_profile_median": f"""with {group_medians(RENAMES)}
        select grp, cast(pos as integer) as pos, {_rounded(PROFILE)} from shown""",
    "group_profile_max": f"""with {group_medians({}, 'max({})')}
        select grp, cast(pos as integer) as pos, {_rounded(PROFILE)} from shown""",
    "group_profile_mean": f"with {MEAN_PROFILE} select grp, {_rounded(METRICS)} from profile",
    "summary_stats": SUMMARY,
    "pearson": f"with {MODEL} select round(corr(spend_per_km, activity), 6) as r from model",
    "correlation_matrix": f"with {MASTER} {_corr_cells}",
    "linear_trend": f"""with {MASTER}, fit as (select regr_slope(activity, log_spend) as slope,
          regr_intercept(activity, log_spend) as intercept, min(log_spend) as low, max(log_spend) as high from master),
        grid as (select *, cast(i as integer) as point, low + (high - low) * (i / 99.0::double) as x from fit, range(0, 100) as g(i))
        select point, round(slope, 6) as slope, round(intercept, 6) as intercept, round(x, 6) as x,
          round(slope * x + intercept, 6) as y from grid""",
    "log_trend": f"""with {MASTER}, logged as (select ln(case when spend_total = 0 then cast(0.001 as double) else spend_total end) as lx, activity
          from master where spend_total >= 0),
        fit as (select regr_slope(activity, lx) as slope, regr_intercept(activity, lx) as intercept,
          min(lx) as low, max(lx) as high from logged),
        grid as (select *, cast(i as integer) as point, low + (high - low) * (i / 99.0::double) as spot from fit, range(0, 100) as g(i))
        select point, round(slope, 6) as slope, round(intercept, 6) as intercept, round(exp(spot), 3) as x,
          round(slope * spot + intercept, 6) as y from grid""",
    "spend_histogram": f"""with {MASTER}, edge as (select min(spend_adjusted) as lo, max(spend_adjusted) as hi,
          {money('spend_adjusted')} / count(*) as mean, median(spend_adjusted) as median from master),
        binned as (select least(cast(floor((spend_adjusted - lo) / ((hi - lo) / 30)) as integer) + 1, 30) as bin
          from master, edge),
        counts as (select bin, count(*) as entities from binned group by 1)
        select cast(i as integer) as bin, round(lo + (hi - lo) / 30 * (i - 1), 6) as low,
          round(lo + (hi - lo) / 30 * i, 6) as high, coalesce(entities, 0) as entities,
          round(mean, 6) as mean, round(median, 6) as median
        from range(1, 31) as g(i) cross join edge left join counts on bin = i""",
    "box_stats": f"with {MASTER}, {quartile_cte('master', ['spend_total', 'activity', 'cost_per_activity'])} {box()}",
    "box_stats_by_group": f"""with {MASTER}, {top_groups(10)},
        kept as (select * from master where grp in (select grp from top)),
        {quartile_cte('kept', ['spend_total'], 'grp')} {box('grp')}""",
    "box_outliers": f"""with {MASTER}, {quartile_cte('master', ['spend_total', 'activity', 'cost_per_activity'])}
        select entity_id, metric, round(value, 6) as value from fenced where not inside""",
    "line_box_stats": f"""with lines as (select l_returnflag, l_extendedprice as price, 0 as entity_id from lineitem),
        {quartile_cte('lines', ['price'], 'l_returnflag')} {box('l_returnflag')}""",
    "spend_hierarchy": f"""with {MASTER}, best as (select * from master order by spend_total desc, entity_id limit 120)
        select cast(3 - grouping(grp) - grouping(region) - grouping(name) as integer) as depth, grp, region, name,
          {money('spend_total')} as size,
          round(sum(cost_per_activity * spend_total) / nullif({money('spend_total')}, 0), 6) as colour
        from best group by rollup (grp, region, name)""",
    "spend_band": f"""with {MASTER}, {band('spend_total', 'entity_id', 'master')}
        select entity_id, band_no, {BAND_NAME} as spend_band from banded""",
    "spend_band_lines": f"""with lines as (select {SIGNED} as v, row_number() over () as id from lineitem),
        {band('v', 'id', 'lines')}
        select band_no, {BAND_NAME} as spend_band, count(*) as rows, min(v) as low, max(v) as high from banded group by 1, 2""",
    "minmax_scale": f"""with {group_medians({})} select grp, {', '.join(
        f"round(coalesce(({m} - min({m}) over ()) / nullif(max({m}) over () - min({m}) over (), 0), 0), 6) as {m}_scaled"
        for m in PROFILE)} from shown""",
    "zscore": f"""with {MODEL} select entity_id, {', '.join(
        f"round(({m} - avg({m}) over ()) / stddev_pop({m}) over (), 6) as {m}_z" for m in ('spend_per_km', 'activity')
    )} from model""",
    "group_zscores": f"with {MEAN_PROFILE}, {Z} select grp, {_rounded([f'{m}_z' for m in METRICS])} from z",
    "top_spenders": f"""with {MASTER} select entity_id, name, grp, region, spend_total, round(activity, 6) as activity,
        round(cost_per_activity, 6) as cost_per_activity from master order by spend_total desc, entity_id limit 15""",
    "top_cost": f"""with {MASTER} select entity_id, name, grp, region, round(m.cost_per_activity, 6) as cost_per_activity,
        spend_total, round(m.activity, 6) as activity from master m where m.activity > 0
        order by m.cost_per_activity desc, entity_id limit 15""",
    "top_refunds": f"""with {MASTER} select entity_id, name, grp, region, refund_count, spend_net, spend_total
        from master order by refund_count desc, entity_id limit 15""",
    "label_candidates": f"""with {MASTER} select entity_id, name, round(log_spend, 6) as log_spend,
        round(m.activity, 6) as activity, round(m.cost_per_activity, 6) as cost_per_activity from master m
        where m.activity > 0 order by m.cost_per_activity desc, entity_id limit 8""",
    "label_candidates_raw": f"""with {MASTER} select entity_id, name, spend_total, round(m.activity, 6) as activity,
        round(m.cost_per_activity, 6) as cost_per_activity from master m where m.activity > 0 and spend_total >= 0
        order by m.cost_per_activity desc, entity_id limit 8""",
    "top_entities": f"with {MASTER} select entity_id, spend_total from master order by spend_total desc, entity_id limit 120",
    "reorder_to_list": f"""with {MASTER}, {top_groups(7)}
        select grp, count(*) as entities, cast(any_value(pos) as integer) as pos from master join top using (grp) group by grp""",
    "top_cost_per_item": f"""with {MODEL} select entity_id, name || ' (' || grp || ')' as label,
        round(spend_per_km / (item_total + 1), 6) as cost_per_item
        from model order by spend_per_km / (item_total + 1) desc, entity_id limit 10""",
    "melt_metrics": f"""with {MASTER} select entity_id, 'spend_total' as metric, round(spend_total, 6) as value from master
        union all select entity_id, 'activity', round(activity, 6) from master
        union all select entity_id, 'event_total', cast(event_total as double) from master where event_total > 0""",
    "pivot_sum": f"""select o_custkey, {', '.join(
        f"coalesce({money(f'''case when o_orderstatus = '{s}' then o_totalprice end''')}, 0) as {s}" for s in 'FOP'
    )} from orders group by 1""",
    "stack_dense": f"""with {EXPENSE}, {SPEND} {' union all '.join(
        f"select entity_id, 'spend_{c}' as category, spend_{c} as spend from spend" for c in CATEGORIES)}""",
    "kmeans_choice": "select cast(k as integer) as k, k = 5 as chosen from range(2, 6) as tried(k)",
    "group_distance": f"""with {MEAN_PROFILE}, {Z} select a.grp, b.grp as other,
        round(sqrt({' + '.join(f'pow(a.{m}_z - b.{m}_z, 2)' for m in METRICS)}), 6) as distance
        from z a join z b on a.grp < b.grp""",
    "group_hierarchy": f"""with recursive {MEAN_PROFILE}, {Z},
        state(step, grp, part) as (
          select 0, grp, grp from z
          union all
          select s.step + 1, s.grp, case when s.part = b.b then b.a else s.part end
          from state s, (
            select a.part as a, b.part as b
            from (select part, count(*) as n, {_CENTRE} from state join z using (grp) group by part) a
            join (select part, count(*) as n, {_CENTRE} from state join z using (grp) group by part) b on a.part < b.part
            where (select count(distinct part) from state) > 4
            order by a.n * b.n / (a.n + b.n) * ({' + '.join(f'pow(a.{m}_c - b.{m}_c, 2)' for m in METRICS)}), a.part, b.part
            limit 1) b),
        cut as (select grp, part from state where step = (select max(step) from state)),
        centre as (select part, {_CENTRE} from cut join z using (grp) group by part)
        select grp, cast(dense_rank() over (order by part) - 1 as integer) as cluster,
          round(sqrt({' + '.join(f'pow({m}_z - {m}_c, 2)' for m in METRICS)}), 6) as to_centre
        from cut join z using (grp) join centre using (part)""",
    "scatter_mart": f"""with {MASTER} select entity_id, round(log_spend, 6) as log_spend, round(activity, 6) as activity,
        name, grp, region, spend_total, round(cost_per_activity, 6) as cost_per_activity from master""",
    "scatter_mart_raw": f"""with {MASTER} select entity_id, round(activity, 6) as activity, name, grp, region, spend_total,
        round(cost_per_activity, 6) as cost_per_activity from master where spend_total >= 0""",
    "strip_mart": f"""with {MASTER}, {top_groups(10)} select grp, round(activity, 6) as activity, entity_id, name, region,
        spend_total, round(cost_per_activity, 6) as cost_per_activity from master where grp in (select grp from top)""",
}
ORACLE["category_hierarchy"] = f"""with grid as ({ORACLE['entity_category_grid']})
  select cast(3 - grouping(grp) - grouping(category) - grouping(name) as integer) as depth, grp, category, name,
    {money('spend')} as size, round(sum(spend * spend) / nullif({money('spend')}, 0), 6) as colour
  from grid group by rollup (grp, category, name)"""
