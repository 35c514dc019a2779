"""The registered queries once more, as SQL for an independent engine.

Written against the raw tables, with plain window functions and joins over whole tables.
"""

from __future__ import annotations

import re

from strataflow.operators.prompts import CONTEXT_HEADER, JUDGE_HEADERS, QUESTION_HEADER, SYSTEM_PROMPT

RUN_TS = "2024-01-01 00:00:00"
_TS = "'%Y-%m-%d %H:%M:%S'"

# --- common table expressions ----------------------------------------------------------

CTES = {
    "trips": """
        select case when l_linestatus = 'F' then 'yellow' else 'green' end as taxi_type,
               case when l_partkey % 50 <> 0 then cast(l_suppkey as varchar) end as vendor,
               o_orderdate as pickup,
               case when l_partkey % 40 <> 0 then l_shipdate end as dropoff,
               cast(l_linenumber as bigint) as passengers,
               nullif(l_quantity, 50) as distance,
               case when l_partkey % 30 <> 0 then cast(l_partkey % 10 as varchar) end as pu,
               cast(l_suppkey % 10 as varchar) as dropped_at,
               l_returnflag as payment,
               case when l_linenumber = 7 and l_quantity < 10 then -l_extendedprice
                    else l_extendedprice end as fare,
               l_quantity * l_linenumber / 4.0e0 as tip,
               l_extendedprice * (1 + l_tax) as total
        from lineitem join orders on l_orderkey = o_orderkey""",
    "keyed": """
        select *, sha256(concat_ws('|', coalesce(vendor, ''), strftime(pickup, '%Y-%m-%d %H:%M:%S'),
                                   coalesce(pu, ''))) as trip_id
        from trips""",
    "silver": """
        select trip_id, pickup, dropoff,
               date_diff('second', pickup, dropoff) / 60.0e0 as duration,
               passengers, distance, pu, dropped_at, payment, fare, tip, total, taxi_type,
               strftime(pickup, '%Y-%m-%d') as pickup_date
        from keyed where fare >= 0 and distance >= 0 and pickup is not null
        qualify row_number() over (partition by taxi_type, trip_id order by
            dropoff nulls last, passengers nulls last, distance nulls last, dropped_at nulls last,
            payment nulls last, fare nulls last, tip nulls last, total nulls last) = 1""",
    "observations": """
        select o_orderpriority as station, o_orderdate as ts, 40.7e0 as latitude, -74.0e0 as longitude,
               case when day(o_orderdate) <> 13 then (o_custkey % 400) / 8.0e0 end as temperature,
               case when day(o_orderdate) <> 13 then cast(o_custkey % 30 as double) end as wind,
               case when day(o_orderdate) <> 13 then cast(nullif(o_custkey % 7, 0) as double) end as precip,
               o_totalprice, o_custkey
        from orders""",
    "wsilver": """
        select *, strftime(ts, '%Y-%m-%d') as weather_date from observations where ts is not null
        qualify row_number() over (partition by station, ts
                                   order by o_totalprice nulls last, o_custkey nulls last) = 1""",
    "wdaily": """
        select weather_date, avg(temperature) as t, avg(precip) as p from wsilver group by 1""",
    "gold": """
        select d.*, t as avg_temperature_c, p as avg_precip_depth_mm from (
            select pickup_date as summary_date, taxi_type, pu as pu_location_id, count(*) as trip_count,
                   avg(fare) as avg_fare, avg(tip) as avg_tip, avg(distance) as avg_distance,
                   avg(duration) as avg_duration_min
            from silver group by 1, 2, 3) d
        left join wdaily on weather_date = summary_date""",
    "samples": """
        select feature, case when year(pickup) = 1995 then 'ref' else 'cur' end as side, value from (
            unpivot (select pickup, fare as fare_amount, distance as trip_distance, tip as tip_amount from silver
                     where year(pickup) in (1995, 1999))
            on fare_amount, trip_distance, tip_amount into name feature value value)
        where value is not null""",
    "shifted": """
        select feature, case when year(l_shipdate) = 1995 then 'ref' else 'cur' end as side, value from (
            unpivot (select l_shipdate, l_quantity,
                            l_extendedprice * case when year(l_shipdate) = 1999 then 1.35e0 else 1.0e0 end
                                as l_extendedprice
                     from lineitem where year(l_shipdate) in (1995, 1999))
            on l_extendedprice, l_quantity into name feature value value)""",
    "tokens": r"""
        select doc_id as id, term, count(*) as tf from (
            select doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) as term from documents)
        where term <> '' group by 1, 2""",
    "lengths": """
        select doc_id as id, coalesce(sum(tf), 0) as dl
        from documents left join tokens on doc_id = id group by 1""",
    "hits": """
        select qid, id, score, row_number() over (partition by qid order by score desc, id) as rank from (
            select qid, id, round(sum(
                       ln(1 + (n - df + 0.5e0) / (df + 0.5e0)) * tf * 2.2e0
                       / (tf + 1.2e0 * (0.25e0 + 0.75e0 * dl / avgdl))), 9) as score
            from terms join tokens using (term)
            join (select term, count(*) as df from tokens group by 1) using (term)
            join lengths using (id)
            join (select count(*) as n, avg(dl) as avgdl from lengths) on true
            {where}
            group by 1, 2)
        qualify rank <= 5""",
    "vhits": """
        select qid, id, score, row_number() over (partition by qid order by score desc, id) as rank from (
            select item_id as qid, v.vec_id as id,
                   round(list_cosine_similarity(cast(q.embedding as double[]),
                                                cast(v.embedding as double[])), 9) as score
            from benchmark join embeddings q on item_id = q.vec_id
            join embeddings v on true {where})
        qualify rank <= 5""",
    "fused": """
        select qid, id, score, row_number() over (partition by qid order by score desc, id) as rank from (
            select qid, id, round(sum(1.0e0 / (60 + rank)), 9) as score from (
                select qid, id, rank from hits union all select qid, id, rank from vhits)
            group by 1, 2)
        qualify rank <= 5""",
    "terms": r"""
        select distinct item_id as qid, term from (
            select item_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) as term from benchmark)
        where term <> ''""",
    "pair_terms": r"""
        select distinct qid, term from (
            select qid, unnest(string_split_regex(lower(question), '[^\p{L}\p{N}]+')) as term from pairs)
        where term <> ''""",
    "pairs": """
        select concat_ws('-', u.conv_id, u.turn) as qid, u.conv_id, u.text as question, a.text as response
        from conversations u join conversations a
          on a.conv_id = u.conv_id and a.turn = u.turn + 1
        where u.role = 'user' and a.role = 'assistant'""",
    "contexts": """
        select item_id as qid, text as question, coalesce(source_ids, '') as source_ids,
               coalesce(context, '') as context
        from benchmark left join (
            select qid, string_agg(cast(id as varchar), ',' order by rank) as source_ids,
                   string_agg('[' || rank || '] ' || text, chr(10) || chr(10) order by rank) as context
            from hits join documents on doc_id = id group by 1) on qid = item_id
        where not regexp_full_match(text, '\\s*')""",
    "answers": """
        select pairs.qid, conv_id, question, response, coalesce(n, 0) as n_chunks, context from pairs left join (
            select qid, count(*) as n, string_agg(text, chr(10) || chr(10) order by rank) as context
            from hits join documents on doc_id = id group by 1) c on c.qid = pairs.qid""",
    "judged": """
        select doc_id, case
            when doc_id % 20 = 0 then '{"groundedness": 4, "relevance":'
            when doc_id % 25 = 1 then '{"groundedness": ' || quality || ', "relevance": 3}'
            when doc_id % 40 = 9 then '[4, 4, 4]'
            else '{"groundedness": ' || case doc_id % 30
                     when 2 then '"4.7"' when 3 then '4.7' when 4 then '"4"' when 6 then 'true'
                     when 7 then 'null' else cast(2 + 3 * quality as varchar) end
                 || ', "relevance": ' || (5 - 3 * toxic) || ', "coherence": ' || (3 + quality) || '}'
            end as raw
        from labels""",
    "parsed": """
        select doc_id, raw, j, {keys} from (select *, try_cast(raw as json) as j from judged)""",
    "scored": """
        select *, case
            when j is null then 'malformed JSON'
            when json_type(j) <> 'OBJECT' then 'not an object'
            when t_groundedness is null then 'missing groundedness'
            when t_relevance is null then 'missing relevance'
            when t_coherence is null then 'missing coherence'
            when groundedness is null then 'not an integer: groundedness'
            when relevance is null then 'not an integer: relevance'
            when coherence is null then 'not an integer: coherence' end as error,
            groundedness >= 3 and relevance >= 3 and coherence >= 3 as passed
        from parsed""",
    "metrics": """
        select ts, event_type as feature, value / 490 as psi from events""",
    "alerts": """
        select time_bucket(interval 5 minutes, ts, timestamp '2000-01-01') as start, feature,
               max(psi) as max_psi
        from metrics group by 1, 2 having max(psi) > 0.2""",
    "messages": """
        select event_id, '{' || case when event_id % 19 = 0 then '' else '"feature": "' || event_type || '", ' end
               || '"score": ' || value || ', "threshold": 0.2, "pipeline_run_id": "run-' || user_id
               || case when event_id % 17 = 0 then '"' else '"}' end as raw
        from events""",
}


def _score_key(name: str) -> str:
    value = f"json_extract_string(j, '$.{name}')"
    return f"""json_type(j, '$.{name}') as t_{name},
        case json_type(j, '$.{name}')
            when 'VARCHAR' then case when regexp_full_match({value}, '\\s*[+-]?\\d+\\s*')
                                     then try_cast(trim({value}) as bigint) end
            when 'BOOLEAN' then case when {value} = 'true' then 1 else 0 end
            when 'DOUBLE' then cast(trunc(cast({value} as double)) as bigint)
            when 'BIGINT' then cast({value} as bigint)
            when 'UBIGINT' then cast({value} as bigint) end as {name}"""


CTES["parsed"] = CTES["parsed"].format(
    keys=",".join(_score_key(n) for n in ("groundedness", "relevance", "coherence")))


def _with(body: str, **changed: str) -> str:
    """Prefix ``body`` with the expressions it needs, in dependency order."""
    ctes = {name: changed.get(name, sql).replace("{where}", changed.get(f"{name}_where", ""))
            for name, sql in {**CTES, **{k: v for k, v in changed.items() if not k.endswith("_where")}}.items()}
    needed: list[str] = []

    def need(sql: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                need(ctes[name])
                needed.append(name)

    need(body)
    listed = ",\n".join(f"{name} as ({ctes[name]})" for name in needed)
    return f"with {listed}\n{body}" if listed else body


def _drift_ctes(keys: str = "feature", source: str = "samples") -> dict[str, str]:
    """Frequency, cumulative, quantile, histogram and index expressions over two samples."""
    on = " and ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return {
        "freq": f"""select {keys}, value, count(*) filter (side = 'ref') as n_ref,
                           count(*) filter (side = 'cur') as n_cur from {source} group by all""",
        "cum": f"""select *, sum(n_ref) over w as cum_ref, sum(n_cur) over w as cum_cur,
                          sum(n_ref) over g as total_ref, sum(n_cur) over g as total_cur,
                          lead(value) over w as next_value
                   from freq window w as (partition by {keys} order by value), g as (partition by {keys})""",
        "stats": f"""select {keys}, max(total_ref) as n_ref, max(total_cur) as n_cur,
                            max(abs(cum_ref / total_ref - cum_cur / total_cur)) as ks,
                            sum(abs(cum_ref / total_ref - cum_cur / total_cur) * (next_value - value)) as w1
                     from cum group by {keys}""",
        "quants": f"""select {keys}, quantile_cont(value,
                          [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as q
                      from {source} where side = 'ref' group by {keys}""",
        "edges": f"""select *, row_number() over w as bin, lead(low) over w as high,
                            row_number() over w + 1 = count(*) over (partition by {keys}) as is_last
                     from (select distinct {keys}, unnest(q) as low from quants)
                     window w as (partition by {keys} order by low)""",
        "bins": f"""select {', '.join('a.' + k for k in keys.split(', '))}, bin, low, high,
                           coalesce(sum(n_ref), 0) as n_ref, coalesce(sum(n_cur), 0) as n_cur
                    from (select * from edges where high is not null) a left join freq b
                      on {on} and value >= low and (value < high or is_last and value = high)
                    group by all""",
        "psis": f"""select {keys}, sum((c - r) * ln(c / r)) as psi from (
                        select *, n_ref / sum(n_ref) over p + 1e-6 as r, n_cur / sum(n_cur) over p + 1e-6 as c
                        from bins window p as (partition by {keys})) group by {keys}""",
        "report": f"""select {keys}, cast(n_ref as bigint) as n_ref, cast(n_cur as bigint) as n_cur, psi, ks,
                             case when arg < 0.04 then 1.0 else greatest(0.0, least(1.0, list_sum(list_transform(
                                 range(1, 101), lambda k: case when k % 2 = 1 then 2.0 else -2.0 end
                                                          * exp(-2.0 * k * k * arg * arg))))) end as p,
                             w1, psi > 0.2 or ks > 0.1 as is_drifted, 'ok' as status
                      from (select *, (sqrt(e) + 0.12 + 0.11 / sqrt(e)) * ks as arg from (
                              select *, n_ref * n_cur / cast(n_ref + n_cur as double) as e
                              from stats join psis using ({keys})))""",
    }


def _drift(body: str, keys: str = "feature", source: str = "samples", **changed: str) -> str:
    return _with(body, **_drift_ctes(keys, source), **changed)


_REPORT = """select {keys}, n_ref, n_cur, round(psi, 6) as psi, round(ks, 6) as ks_statistic,
    round(p, 6) as ks_p_value, round(w1, 6) as wasserstein, is_drifted, status from report"""

_SILVER = f"""trip_id, strftime(pickup, {_TS}) as pickup_ts, strftime(dropoff, {_TS}) as dropoff_ts,
    round(duration, 6) as trip_duration_min, passengers as passenger_count, round(distance, 6) as trip_distance,
    pu as pu_location_id, dropped_at as do_location_id, payment as payment_type, round(fare, 6) as fare_amount,
    round(tip, 6) as tip_amount, round(total, 6) as total_amount, taxi_type, pickup_date,
    '{RUN_TS}' as _silver_ts"""

_WSILVER = f"""station as station_name, strftime(ts, {_TS}) as weather_ts, latitude, longitude,
    round(temperature, 6) as temperature_c, round(wind, 6) as wind_speed_ms, round(precip, 6) as precip_depth_mm,
    strftime(ts, '%Y-%m-%d') as weather_date, '{RUN_TS}' as _silver_ts"""

_MEANS = """round(avg_fare, 6) as avg_fare, round(avg_tip, 6) as avg_tip, round(avg_distance, 6) as avg_distance,
    round(avg_duration_min, 6) as avg_duration_min"""
_CONTEXT = "round(avg_temperature_c, 6) as avg_temperature_c, round(avg_precip_depth_mm, 6) as avg_precip_depth_mm"
_GOLD = f"summary_date, taxi_type, pu_location_id, trip_count, {_MEANS}, {_CONTEXT}, '{RUN_TS}' as _gold_ts"

_TRIP_COLUMNS = f"""taxi_type, vendor as "vendorID", strftime(pickup, {_TS}) as pickup,
    strftime(dropoff, {_TS}) as dropoff, passengers as "passengerCount", distance as "tripDistance",
    pu as "puLocationId", dropped_at as "doLocationId", payment as "paymentType", fare as "fareAmount",
    tip as "tipAmount", round(total, 6) as "totalAmount", year(pickup) as "puYear", month(pickup) as "puMonth" """

_ORDERS = f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {_TS}) as o_orderdate, o_orderpriority"

_PROFILE = """
select feature, non_null, round(1 - non_null / n, 4) as null_rate, round(mean, 4) as mean,
       round(sd, 4) as stddev, round(low, 4) as min, p25, p50, p75, round(high, 4) as max
from (select feature, count(*) as n, count(value) as non_null, avg(value) as mean, stddev(value) as sd,
             min(value) as low, max(value) as high from long group by 1)
left join (select feature, min(value) filter (r >= 0.25 * c) as p25, min(value) filter (r >= 0.5 * c) as p50,
                  min(value) filter (r >= 0.75 * c) as p75
           from (select *, row_number() over (partition by feature order by value) as r,
                        count(*) over (partition by feature) as c from long where value is not null)
           group by 1) using (feature)"""


def _long(selects: dict[str, str], source: str) -> str:
    return " union all ".join(
        f"select '{name}' as feature, cast({expr} as double) as value from {source}" for name, expr in selects.items())


_HISTORY = """
    select *, timestamp '2023-01-01' as ingested from trips where pickup < timestamp '1999-01-01'
    union all
    select * replace (case when pickup < timestamp '1999-01-01' then fare + 1 else fare end as fare),
           timestamp '2023-02-01' as ingested
    from trips where pickup >= timestamp '1999-01-01' or taxi_type = 'green'"""
_KEYED_HISTORY = CTES["keyed"].replace("from trips", "from history {where}")
_LATEST = CTES["silver"].replace("order by\n", "order by ingested desc,\n")

_UPSERTED = f"""
select {_SILVER} from silver where pickup_date < '1998-07-01'
union all
select {_SILVER.replace('round(total, 6)', 'round(total + 1, 6)')} from silver where pickup_date >= '1998-07-01'"""

_RANKED = "select qid, id, round(score, 6) as score, cast(rank as bigint) as rank from {name}"
_METRIC = f"'{RUN_TS}' as ts"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql() -> dict[str, str]:
    number = lambda c: f"case when {c} is null then 'n/a' else format('{{:.6f}}', round({c}, 6)) end"
    docs = (
        "'On ' || summary_date || ', ' || taxi_type || ' trips from zone ' || coalesce(pu_location_id, 'unknown')"
        " || ': ' || trip_count || ' trips, average fare ' || " + number("avg_fare")
        + " || ', tip ' || " + number("avg_tip") + " || ', distance ' || " + number("avg_distance")
        + " || ', duration ' || " + number("avg_duration_min") + " || ' min, temperature ' || "
        + number("avg_temperature_c") + " || ' C, precipitation ' || " + number("avg_precip_depth_mm") + " || ' mm.'"
    )
    operations = """select strftime(ts, '%Y-%m-%d') as summary_date, 's' || (user_id % 5) as source_system,
        event_type as category, count(*) as event_count, count(*) filter (event_type = 'error') as critical_count,
        round(avg(value), 6) as avg_numeric_value from events group by 1, 2, 3"""
    user = f"{_literal(CONTEXT_HEADER)} || context || {_literal(QUESTION_HEADER)} || question || chr(10)"
    shifted_report = _drift(_REPORT.format(keys="feature"), source="shifted")
    by_type = CTES["samples"].replace("select feature", "select taxi_type, feature").replace(
        "select pickup,", "select taxi_type, pickup,")
    en_fr = "where id in (select doc_id from documents where lang in ('en', 'fr'))"
    judge = [_literal(h) for h in JUDGE_HEADERS]
    latest_silver = {"history": _HISTORY, "silver": _LATEST}
    return {
        "source_scan": f"select {_ORDERS} from orders",
        "source_formats": " union all ".join(
            f"select '{f}' as format, {_ORDERS} from orders" for f in ("parquet", "json", "csv")),
        "source_fallback": "select * replace (cast(c_nationkey as bigint) as c_nationkey) from customer",
        "bronze_slice": _with(f"""select vendor as "vendorID", strftime(pickup, {_TS}) as "tpepPickupDatetime",
            distance as "tripDistance", fare as "fareAmount", pu as "puLocationId", year(pickup) as "puYear",
            month(pickup) as "puMonth" from trips
            where taxi_type = 'yellow' and year(pickup) = 1997 and month(pickup) = 3"""),
        "bronze_audit": _with(f"""select 'noaa_weather' as _source_name, '{RUN_TS}' as _ingested_ts,
            year(ts) as year, count(*) as n_rows, count(*) as n_with_file from observations group by year(ts)"""),
        "bronze_profile": _with(_PROFILE, long=_long({
            "fareAmount": "fare", "tripDistance": "distance", "passengerCount": "passengers", "tipAmount": "tip",
        }, "trips")),
        "source_profile": _with(_PROFILE, long=_long({
            "temperature": "temperature", "dewPoint": "null", "seaLvlPressure": "null", "windSpeed": "wind",
            "precipTime": "null", "precipDepth": "precip"}, "observations")),
        "silver_slice": _with(f"select {_TRIP_COLUMNS} from trips where year(pickup) = 1998 and month(pickup) = 2"),
        "silver_trips": _with(f"select {_SILVER} from silver"),
        "silver_weather": _with(f"select {_WSILVER} from wsilver"),
        "weather_slice": _with(
            f"select {_WSILVER} from wsilver where year(ts) = 1998 and month(ts) = 11",
            wsilver=CTES["wsilver"].replace("o_totalprice nulls last, o_custkey nulls last",
                                            "temperature nulls last, wind nulls last, precip nulls last")),
        "silver_rejects": _with("""select taxi_type, reason, count(*) as n_rows from (
            select taxi_type, unnest([case when fare is null then 'null_fare' end,
                case when fare < 0 then 'negative_fare' end, case when distance is null then 'null_distance' end,
                case when distance < 0 then 'negative_distance' end,
                case when pickup is null then 'null_pickup' end]) as reason from trips)
            where reason is not null group by 1, 2"""),
        "trip_key": _with(f"""select trip_id, vendor as "vendorID", strftime(pickup, {_TS}) as pickup,
            pu as "puLocationId" from keyed"""),
        "schema_enforce": """select c_custkey,
            case when ok then cast(c_nationkey as bigint) end as c_nationkey,
            case when ok then c_acctbal end as c_acctbal, c_mktsegment, cast(null as varchar) as c_comment,
            concat_ws(',', case when no_nation then 'null:c_nationkey' end,
                      case when bad_balance then 'bad_type:c_acctbal' end) as violations
            from (select *, not no_nation and not bad_balance as ok from (
                select *, c_custkey % 13 = 0 as no_nation, c_custkey % 11 = 0 as bad_balance from customer))""",
        "silver_as_of": _with(f"select {_SILVER} from silver", keyed=_KEYED_HISTORY,
                              keyed_where="where ingested <= timestamp '2023-01-15'", **latest_silver),
        "silver_latest": _with(f"select {_SILVER} from silver", keyed=_KEYED_HISTORY, **latest_silver),
        "job_as_of": " union all ".join(
            "select * from (" + _with(
                f"select {_SILVER}, '{ts}' as as_of from silver where taxi_type = 'yellow' and year(pickup) = 1998 and month(pickup) = 3",
                keyed=CTES["keyed"].replace("select *,", f"select * replace (fare + {more} as fare),"),
            ) + ")" for ts, more in (("2023-01-15 00:00:00", 0), ("2023-02-15 00:00:00", 1))),
        "bronze_append": _with("""select 'nyctaxi_' || taxi_type as source,
            case when year(pickup) < 1998 then 'run-early' else 'run-late' end as _ingest_id, year(pickup) as "puYear",
            count(*) as n_rows, round(sum(fare), 2) as sum_fare from trips group by taxi_type, year(pickup)"""),
        "silver_upsert": _with(_UPSERTED),
        "silver_upsert_shared_key": _with(f"""select {_SILVER} from silver where taxi_type = 'green' or
            trip_id not in (select trip_id from silver where taxi_type = 'green')"""),
        "weather_upsert": _with(f"""select {_WSILVER} from wsilver where weather_date < '1998-07-01' union all
            select {_WSILVER.replace('round(temperature, 6)', 'round(temperature + 1, 6)')}
            from wsilver where weather_date >= '1998-07-01'"""),
        "merge_conflicts": _with(f"""select strftime(ts, {_TS}) as weather_ts, count(*) as n_rows from wsilver
            group by ts having count(*) > 1"""),
        "gold_replace_partition": _with(f"""select {_GOLD} from (select * replace (
            case when summary_date in ('1998-03-01', '1998-03-02') then avg_fare + 1 else avg_fare end as avg_fare)
            from gold where summary_date <> '1998-04-03')"""),
        "gold_layout": _with(f"select {_GOLD} from gold"),
        "layer_counts": _with("""select
            (select count(*) from trips where taxi_type = 'yellow' and year(pickup) = 1999) as bronze_yellow_rows,
            (select count(*) from trips where taxi_type = 'green' and year(pickup) = 1999) as bronze_green_rows,
            (select count(*) from observations where year(ts) = 1999) as bronze_weather_rows,
            (select count(*) from silver where year(pickup) = 1999) as silver_rows,
            (select count(*) from gold where summary_date in ('1999-03-01', '1999-03-02')) as gold_rows,
            '1999-03-01,1999-03-02' as partition_date, 'ok' as drift_status"""),
        "gold_daily_summary": _with(f"select {_GOLD} from gold"),
        "gold_no_weather": _with(f"""select summary_date, taxi_type, pu_location_id, trip_count, {_MEANS},
            cast(null as double) as avg_temperature_c, cast(null as double) as avg_precip_depth_mm,
            '{RUN_TS}' as _gold_ts from gold"""),
        "weather_daily": _with("""select weather_date, round(t, 6) as avg_temperature_c,
            round(p, 6) as avg_precip_depth_mm from wdaily"""),
        "view_daily_trip_summary": _with(f"""select summary_date, taxi_type, pu_location_id, trip_count, {_MEANS},
            {_CONTEXT}, round(case when avg_fare > 0 then avg_tip / avg_fare end, 6) as tip_rate,
            '{RUN_TS}' as refreshed_at from gold
            where cast(summary_date as date) >= date '2001-07-31' - interval 90 days"""),
        "view_kpi_last_7_days": _with(f"""select taxi_type, pu_location_id, cast(sum(trip_count) as bigint) as total_trips,
            round(avg(avg_fare), 6) as avg_fare_7d, round(avg(avg_tip / nullif(avg_fare, 0)), 6) as avg_tip_rate_7d,
            round(avg(avg_distance), 6) as avg_distance_7d, round(avg(avg_duration_min), 6) as avg_duration_7d,
            round(avg(avg_temperature_c), 6) as avg_temp_c_7d, '{RUN_TS}' as last_refresh from gold
            where cast(summary_date as date) >= date '2001-07-31' - interval 7 days group by 1, 2"""),
        "view_yearly_fare_distribution": _with("""select left(summary_date, 4) as pickup_year, taxi_type,
            count(*) as day_count, round(avg(avg_fare), 6) as mean_fare, round(min(avg_fare), 6) as min_fare,
            round(max(avg_fare), 6) as max_fare from gold group by 1, 2"""),
        "yearly_distinct_days": _with("""select left(summary_date, 4) as pickup_year, taxi_type,
            count(distinct summary_date) as distinct_days from gold group by 1, 2"""),
        "daily_operations_summary": operations,
        "fact_operations": f"""select summary_date as "Date", source_system as "Source System",
            category as "Category", event_count as "Event Count", critical_count as "Critical Count",
            avg_numeric_value as "Avg Numeric Value" from ({operations})""",
        "dim_date": """select strftime(d, '%Y-%m-%d') as date_key, year(d) as year, quarter(d) as quarter,
            month(d) as month, weekofyear(d) as week, isodow(d) < 6 as is_weekday
            from (select unnest(generate_series(min(date_trunc('day', o_orderdate)),
                  max(date_trunc('day', o_orderdate)), interval 1 day)) as d from orders)""",
        "drift_input": _with("select feature, side, round(value, 6) as value from samples"),
        "drift_freq": _drift("select feature, round(value, 6) as value, n_ref, n_cur from freq"),
        "drift_cumulative": _drift("""select feature, round(value, 6) as value, n_ref, n_cur,
            cast(cum_ref as bigint) as cum_ref, cast(cum_cur as bigint) as cum_cur,
            cast(total_ref as bigint) as total_ref, cast(total_cur as bigint) as total_cur,
            round(next_value, 6) as next_value from cum"""),
        "drift_quantiles": _drift("""select feature, i, round(q[i + 1], 9) as quantile
            from (select feature, q, unnest(range(0, 11)) as i from quants)"""),
        "psi_bins": _drift("""select feature, bin, round(low, 6) as low, round(high, 6) as high,
            cast(n_ref as bigint) as n_ref, cast(n_cur as bigint) as n_cur from bins"""),
        "drift_psi": _drift("select feature, round(psi, 9) as psi from psis"),
        "drift_ks": _drift("select feature, round(ks, 9) as ks_statistic from stats"),
        "drift_wasserstein": _drift("select feature, round(w1, 6) as wasserstein from stats"),
        "drift_report": _drift(_REPORT.format(keys="feature")),
        "drift_report_partials": _drift(_REPORT.format(keys="feature")),
        "drift_report_shifted": shifted_report,
        "drift_by_type": _drift(_REPORT.format(keys="taxi_type, feature"), keys="taxi_type, feature", samples=by_type),
        "drift_violations": _drift("""select feature, case when psi > 0.2 then 'psi' else 'ks_statistic' end as measure,
            round(case when psi > 0.2 then psi else ks end, 6) as score,
            case when psi > 0.2 then 0.2e0 else 0.1e0 end as threshold from report where is_drifted""",
            source="shifted"),
        "drift_empty": _with("""select feature, count(value) as n_ref, cast(0 as bigint) as n_cur,
            cast(null as boolean) as is_drifted,
            case when count(value) = 0 then 'empty_reference' else 'empty_current' end as status
            from (select feature, value from samples where side = 'ref'
                  union all select 'not_measured', null) group by feature"""),
        "drift_metrics": _drift(f"""select 'drift.' || measure as metric, 'feature' as attr_key, feature as attr_value,
            round(value, 6) as value, {_METRIC} from (
                unpivot (select feature, psi, ks as ks_statistic, w1 as wasserstein from report)
                on psi, ks_statistic, wasserstein into name measure value value)"""),
        "gold_documents": _with(f"""select sha256(concat_ws('|', summary_date, taxi_type,
            coalesce(pu_location_id, ''))) as id, {docs} as content, summary_date, taxi_type,
            coalesce(pu_location_id, 'unknown') as pu_location_id from gold"""),
        "doc_batches": """select (n - 1) // 500 as batch_id, count(*) as n_docs,
            count(*) filter (doc_id is null) as n_missing_id, 'ok' as status
            from (select doc_id, row_number() over (order by doc_id) as n from documents) group by 1""",
        "doc_batches_by_bytes": """with recursive d as (
                select doc_id, octet_length(encode(text)) as b, row_number() over (order by doc_id) as n from documents),
            chain as (
                select n, doc_id, b, b as filled, 1 as docs, cast(0 as bigint) as batch_id from d where n = 1
                union all
                select d.n, d.doc_id, d.b, case when fits then filled + d.b else d.b end, case when fits then docs + 1 else 1 end,
                    case when fits then batch_id else batch_id + 1 end
                from (select n, doc_id, b, filled, docs, batch_id from chain) c join d on d.n = c.n + 1,
                    lateral (select c.docs < 40 and c.filled + d.b <= 100000 as fits))
            select batch_id, count(*) as n_docs, cast(sum(b) as bigint) as n_bytes, min(doc_id) as first_id, max(doc_id) as last_id
            from chain group by 1""",
        "bm25_topk": _with(_RANKED.format(name="hits")),
        "vector_topk": _with(_RANKED.format(name="vhits")),
        "vector_index_recall": _with("select count(*) as n_exact, true as enough from vhits"),
        "vector_index_topk": _with(_RANKED.format(name="vhits")),
        "hybrid_topk": _with(_RANKED.format(name="fused")),
        "hybrid_filtered": _with(_RANKED.format(name="fused"), hits_where=en_fr,
                                 vhits_where="join documents on doc_id = v.vec_id where lang in ('en', 'fr')"),
        "search_results": _with("""select qid, cast(rank as bigint) as rank, id, text as content,
            round(score, 6) as score, lang, source from hits join documents on doc_id = id"""),
        "rag_context": _with("select qid, question, source_ids, context from contexts"),
        "rag_messages": _with(f"""select qid, cast(0 as bigint) as i, 'system' as role, {_literal(SYSTEM_PROMPT)} as content from contexts
            union all select qid, cast(1 as bigint), 'user', {user} from contexts"""),
        "judge_inputs": _with(f"""select qid, {judge[0]} || context || {judge[1]} || question || {judge[2]} ||
            response || chr(10) as judge_input from answers where n_chunks > 0""", terms=CTES["pair_terms"]),
        "eval_parse": _with("""select doc_id, groundedness, relevance, coherence, passed from scored
            where error is null"""),
        "eval_rejects": _with("select doc_id, raw, error from scored where error is not null"),
        "eval_join": _with("""select qid, n_chunks, groundedness, relevance, coherence, passed from answers
            left join (select * from scored where error is null) s on doc_id = conv_id and n_chunks > 0""",
            terms=CTES["pair_terms"]),
        "eval_summary": _with("""select source as deployment, count(*) as n_evaluated,
            round(avg(cast(passed as int)), 6) as pass_rate, round(avg(groundedness), 6) as avg_groundedness,
            round(avg(relevance), 6) as avg_relevance, round(avg(coherence), 6) as avg_coherence
            from scored join documents using (doc_id) where error is null group by 1"""),
        "eval_metrics": _with(f"""select 'llm.eval.' || measure as metric, 'deployment' as attr_key,
            source as attr_value, cast(value as double) as value, {_METRIC} from (
                unpivot (select source, groundedness, relevance, coherence
                         from scored join documents using (doc_id) where error is null)
                on groundedness, relevance, coherence into name measure value value)"""),
        "drift_alerts": _with(f"""select strftime(start, {_TS}) as window_start,
            strftime(start + interval 5 minutes, {_TS}) as window_end, feature, round(max_psi, 6) as max_psi
            from alerts"""),
        "drift_alerts_stream": _with(f"""select strftime(start, {_TS}) as window_start,
            strftime(start + interval 5 minutes, {_TS}) as window_end, feature, round(max_psi, 6) as max_psi
            from alerts"""),
        "metric_alerts": _drift(f"""select strftime(start, {_TS}) as window_start,
            strftime(start + interval 5 minutes, {_TS}) as window_end, feature, round(psi, 6) as max_psi, way
            from report, (values (timestamp '2024-01-01 00:00:00'), (timestamp '2024-01-01 00:05:00')) w(start),
                (values ('batch'), ('stream')) v(way)
            where psi > 0.2 and status = 'ok'""", source="shifted", shifted=CTES["shifted"].replace("1.35e0", "0.3e0")),
        "alert_parse": """select event_id, event_type as feature, round(value, 6) as score, 0.2e0 as threshold,
            'run-' || user_id as pipeline_run_id from events where event_id % 19 <> 0 and event_id % 17 <> 0""",
        "alert_rejects": _with("select event_id, raw from messages where event_id % 19 = 0 or event_id % 17 = 0"),
    }
