"""DuckDB oracle SQL for the registered queries.

Each statement is prefixed with the stand-in views it needs as a ``WITH``
clause; DuckDB only has the driver's base tables registered.
"""

from __future__ import annotations

import re

# Stand-in views, in dependency order.
VIEWS = {
    "raw_acc": (
        "select cast(o_orderkey as varchar) as id, case when o_orderkey % 97 = 0 then 'bad' else cast(o_orderdate as varchar) end as start_time, "
        "c_mktsegment as city, n_name || case when c_nationkey % 5 = 0 then ' (old)' else '' end as state, 'Supplier#' || lpad(cast(o_custkey % 200 as varchar), 9, '0') as airport_code, "
        "substr(o_orderpriority, 1, 1) as severity, nullif(o_orderpriority, '4-NOT SPECIFIED') as weather_condition, "
        "o_orderstatus as description, cast(o_totalprice as double) as distance, "
        "case when o_orderkey % 101 = 0 then 'warm' else cast(o_orderkey % 120 as varchar) || '.5' end as temperature, "
        "case when o_orderkey % 7 <> 0 then cast(o_custkey % 60 as varchar) end as wind_speed, "
        "'0.' || cast(o_orderkey % 9 + 1 as varchar) as precipitation, "
        "case when o_orderkey % 89 = 0 then 'n/a' else cast(cast(o_orderdate as date) - 1 as varchar) || ' 05:06:07' end as weather_timestamp "
        "from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"
    ),
    "raw_city": (
        "select c_mktsegment as city, n_name as state, cast(floor(c_acctbal) as bigint) as total_population "
        "from customer join nation on c_nationkey = n_nationkey"
    ),
    "raw_air": (
        "select s_name as ident, case when s_acctbal > 5000 then 'large' else 'small' end as type, s_name as name, "
        "r_name as continent, n_name as iso_country, 'US-' || n_name as iso_region, n_name as municipality "
        "from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"
    ),
    "airports": (
        "select ident as airport_code, substr(iso_region, 4) as state, substr(iso_region, 4) as state_code, type, name, municipality "
        "from raw_air where continent = 'AMERICA' and iso_country = 'NATION_11'"
    ),
    "cities": (
        "select cast(row_number() over (order by city, state) - 1 as bigint) as city_id, city as city_name, state, "
        "state as state_code, min(total_population) as total_population from raw_city group by city, state"
    ),
    "weather_conditions": (
        "select cast(row_number() over (order by condition nulls first) - 1 as bigint) as weather_condition_id, condition "
        "from (select distinct weather_condition as condition from raw_acc) w"
    ),
    "accidents": (
        "select id as accident_id, cast(year(d) as int) as year, cast(month(d) as int) as month, d as datetime, "
        "try_cast(severity as int) as severity, distance, description, airport_code, city_id, weather_condition_id, "
        "try_cast(start_time as timestamp) as start_time, try_cast(substr(weather_timestamp, 1, 10) as date) as weather_date, "
        "try_cast(temperature as double) as temperature, try_cast(wind_speed as double) as wind_speed, try_cast(precipitation as double) as precipitation "
        "from (select r.*, try_cast(start_time as date) as d from raw_acc r) a "
        "join cities c on a.city = c.city_name and a.state = c.state_code "
        "left join weather_conditions w on a.weather_condition = w.condition"
    ),
}
DEPENDS = {
    "airports": ["raw_air"],
    "cities": ["raw_city"],
    "weather_conditions": ["raw_acc"],
    "accidents": ["raw_acc", "cities", "weather_conditions"],
}

QUERIES = {
    "scan_csv_comma": "select cast(event_id as varchar) as event_id, event_type, props from events",
    "scan_csv_semicolon": "select city, state from raw_city",
    "scan_parquet_flat": "select n_nationkey, n_name from nation",
    "scan_parquet_part1": "select airport_code, state from airports",
    "scan_parquet_part2": "select accident_id, year, month from accidents",
    "sink_flat_roundtrip": "select c_custkey, c_name, c_nationkey, c_mktsegment from customer",
    "sink_part1_roundtrip": "select s_suppkey, s_name, s_nationkey from supplier",
    "sink_part2_roundtrip": "select o_orderkey, cast(year(o_orderdate) as int) as y, cast(month(o_orderdate) as int) as m from orders",
    "sql_preview": (
        "select accident_id, datetime, start_time, weather_date, severity, distance, description, temperature, wind_speed, precipitation, "
        "airport_code, city_id, weather_condition_id, year, month from accidents order by accident_id limit 10"
    ),
    "sql_count_month_text": "select count(*) as n from accidents where year = 1997 and month = 5",
    "preview_5": "select accident_id, city_id, severity from accidents order by accident_id limit 5",
    "load_report": (
        "select 'raw_accidents' as stage, count(*) as n from raw_acc union all select 'joined', count(*) from accidents "
        "union all select 'dropped_no_city', (select count(*) from raw_acc) - (select count(*) from accidents) "
        "union all select 'cities', count(*) from cities union all select 'airports', count(*) from airports"
    ),
    "chunk_assign": "select o_orderkey, cast(floor((row_number() over (order by o_orderkey) - 1) / 4000) as bigint) as chunk from orders",
    "chunk_sizes": (
        "select chunk, count(*) as n from (select cast(floor((row_number() over (order by o_orderkey) - 1) / 4000) as bigint) as chunk "
        "from orders) t group by chunk"
    ),
    "land_raw_counts": (
        "select 'accidents' as dataset, count(*) as n, cast(ceil(count(*) / 4000) as bigint) as chunks from raw_acc "
        "union all select 'cities', count(*), cast(ceil(count(*) / 1000) as bigint) from raw_city "
        "union all select 'airports', count(*), cast(ceil(count(*) / 10) as bigint) from raw_air"
    ),
    "land_source_order": (
        "select event_id, event_type, cast(floor((row_number() over (order by event_id) - 1) / 700) as bigint) as chunk from events"
    ),
    "land_content": (
        "select 'accidents' as dataset, count(*) as verified_rows from raw_acc union all select 'cities', count(*) from raw_city "
        "union all select 'airports', count(*) from raw_air"
    ),
    "land_source_multiline": (
        "select doc_id, lang, md5(text) as text_md5, cast(floor((row_number() over (order by doc_id) - 1) / 300) as bigint) as chunk from documents"
    ),
    "file_keys": (
        "select 'accident_data' as dataset, unnest(range(cast(ceil(count(*) / 4000) as bigint))) as chunk from raw_acc "
        "union all select 'city_data', unnest(range(cast(ceil(count(*) / 1000) as bigint))) from raw_city "
        "union all select 'airport_data', unnest(range(cast(ceil(count(*) / 10) as bigint))) from raw_air"
    ),
    "dq_file_count": (
        "select cast(ceil((select count(*) from raw_acc) / 4000) + ceil((select count(*) from raw_city) / 1000) "
        "+ ceil((select count(*) from raw_air) / 10) as bigint) as files"
    ),
    "build_lake": (
        "select 'accidents' as table_name, count(*) as n from accidents union all select 'cities', count(*) from cities "
        "union all select 'airports', count(*) from airports union all select 'weather_conditions', count(*) from weather_conditions "
        "union all select 'dropped_no_city', (select count(*) from raw_acc) - (select count(*) from accidents)"
    ),
    "project_subset": "select id, start_time, city, state, airport_code from raw_acc",
    "project_rename": "select id as accident_id, weather_condition as condition from raw_acc",
    "project_duplicate": "select airport_code, state, state_code from airports",
    "project_computed": "select id, city || ', ' || state as place from raw_acc",
    "surrogate_key_city": "select city_id, city_name, state from cities",
    "surrogate_key_weather": "select weather_condition_id, condition from weather_conditions",
    "typed_fact": (
        "select accident_id, severity, distance, datetime, start_time, weather_date, temperature, wind_speed, precipitation from accidents"
    ),
    "filter_eq": "select ident, continent from raw_air where continent = 'AMERICA'",
    "filter_and": "select ident from raw_air where continent = 'AMERICA' and iso_country = 'NATION_11'",
    "join_inner_composite": "select r.id, c.city_id from raw_acc r join cities c on r.city = c.city_name and r.state = c.state_code",
    "join_left_using": "select r.id, r.airport_code, a.type from raw_acc r left join airports a on r.airport_code = a.airport_code",
    "join_left_null_key": "select r.id, w.weather_condition_id from raw_acc r left join weather_conditions w on r.weather_condition = w.condition",
    "star_enrich": (
        "select r.id, c.city_id, a.type as airport_type, w.weather_condition_id from raw_acc r "
        "join cities c on r.city = c.city_name and r.state = c.state_code "
        "left join airports a on r.airport_code = a.airport_code "
        "left join weather_conditions w on r.weather_condition = w.condition"
    ),
    "agg_count_all": "select count(*) as n from accidents",
    "dedupe_composite": "select city, state, min(total_population) as total_population from raw_city group by city, state",
    "dedupe_null_group": "select distinct weather_condition as condition from raw_acc",
    "sql_count_month": "select count(*) as n from accidents where year = 1997 and month = 5",
    "sql_city_accidents": (
        "select c.city_name, c.state, a.description, a.accident_id from accidents a join cities c on a.city_id = c.city_id "
        "where c.city_name = 'FURNITURE' and c.state = 'NATION_2'"
    ),
    "sql_by_state": (
        "select c.state, count(*) as accident_count from accidents a join cities c on a.city_id = c.city_id "
        "group by c.state order by accident_count desc, c.state"
    ),
    "mart_city_total": (
        "select count(*) as n from accidents a join cities c on a.city_id = c.city_id "
        "where c.city_name = 'FURNITURE' and c.state = 'NATION_2'"
    ),
    "mart_by_weather": (
        "select w.condition, count(*) as n from accidents a left join weather_conditions w "
        "on a.weather_condition_id = w.weather_condition_id group by w.condition"
    ),
    "mart_by_city": (
        "select c.city_name, c.state, count(*) as n from accidents a join cities c on a.city_id = c.city_id "
        "group by c.city_name, c.state"
    ),
    "mart_by_airport": "select airport_code, count(*) as n from accidents group by airport_code",
    "mart_by_month": "select year, month, count(*) as n from accidents group by year, month",
    "fn_weather_date": "select id, try_cast(substr(weather_timestamp, 1, 10) as date) as d from raw_acc",
    "fn_to_date": "select id, try_cast(start_time as date) as d from raw_acc",
    "fn_year_month": (
        "select id, cast(year(try_cast(start_time as date)) as int) as y, cast(month(try_cast(start_time as date)) as int) as m from raw_acc"
    ),
    "fn_state_code": "select ident, substr(iso_region, 4) as state_code from raw_air",
    "dq_non_empty": (
        "select 'accidents' as table_name, count(*) as observed, count(*) > 0 as passed from accidents "
        "union all select 'cities', count(*), count(*) > 0 from cities "
        "union all select 'airports', count(*), count(*) > 0 from airports "
        "union all select 'weather_conditions', count(*), count(*) > 0 from weather_conditions"
    ),
    "profile_nulls": (
        "select 'start_time' as column_name, count(*) - count(try_cast(start_time as date)) as nulls from raw_acc "
        "union all select 'weather_condition', count(*) - count(weather_condition) from raw_acc "
        "union all select 'city', count(*) - count(city) from raw_acc"
    ),
    "profile_duplicates": (
        "select city, state, count(*) as n, count(distinct total_population) as variants from raw_city "
        "group by city, state having count(*) > 1"
    ),
    "dq_pk_unique": (
        "select 'accidents' as table_name, count(*) as n, count(distinct accident_id) as keys, "
        "count(*) = count(distinct accident_id) as passed from accidents "
        "union all select 'lineitem', (select count(*) from lineitem), count(*), (select count(*) from lineitem) = count(*) "
        "from (select distinct l_orderkey, l_linenumber from lineitem) k"
    ),
    "dq_fk_orphans": (
        "select 'airport' as fk, count(*) as orphans from accidents a where a.airport_code is not null and not exists "
        "(select 1 from airports p where p.airport_code = a.airport_code) "
        "union all select 'city', count(*) from accidents a where a.city_id is not null and not exists "
        "(select 1 from cities c where c.city_id = a.city_id) "
        "union all select 'weather', count(*) from accidents a where a.weather_condition_id is not null and not exists "
        "(select 1 from weather_conditions w where w.weather_condition_id = a.weather_condition_id)"
    ),
    "dq_range": "select count(*) as violations from accidents where severity not between 1 and 4",
    "dq_format": "select count(*) as violations from accidents where length(airport_code) <> 18",
    "dq_report": (
        "select 'non_empty' as check_name, 'accidents' as table_name, count(*) as observed, count(*) > 0 as passed from accidents "
        "union all select 'severity_range', 'accidents', count(*), count(*) = 0 from accidents where severity not between 1 and 4"
    ),
    "check_lake": " union all ".join([
        *[f"select 'non_empty' as check_name, '{t}' as table_name, count(*) as observed, count(*) > 0 as passed from {t}"
          for t in ("accidents", "cities", "airports", "weather_conditions")],
        *[f"select '{name}', '{t}', count(*), count(*) = 0 from {t} where {bad}" for name, t, bad in (
            ("severity_range", "accidents", "severity not between 1 and 4"),
            ("airport_code_format", "accidents", "length(airport_code) <> 18"),
            ("airport_code_format", "airports", "length(airport_code) <> 18"),
            ("state_code_format", "airports", "not regexp_matches(state_code, '^NATION_[0-9]+$')"),
            ("state_code_format", "cities", "not regexp_matches(state_code, '^NATION_[0-9]+$')"),
            ("fk_city", "accidents", "city_id is not null and city_id not in (select city_id from cities)"),
            ("fk_weather", "accidents", "weather_condition_id is not null and weather_condition_id not in (select weather_condition_id from weather_conditions)"),
        )],
        "select 'fk_airport', 'accidents', count(*), true from accidents a where airport_code is not null and not exists "
        "(select 1 from airports p where p.airport_code = a.airport_code)",
        *[f"select '{c}_nulls', 'accidents', count(*), true from accidents where {c} is null"
          for c in ("datetime", "airport_code")],
        "select 'weather_nulls', 'accidents', count(*), true from accidents where weather_condition_id is null",
        *[f"select '{name}', '{t}', count(*) - count(distinct {key}), count(*) = count(distinct {key}) from {t}" for name, t, key in (
            ("pk_unique", "accidents", "accident_id"), ("pk_unique", "cities", "city_id"), ("pk_unique", "airports", "airport_code"),
            ("pk_unique", "weather_conditions", "weather_condition_id"), ("join_key_unique", "cities", "(city_name, state_code)"),
        )],
        *[f"select 'missing_{name}', 'raw_accidents', {nulls}, true from raw_acc" for name, nulls in (
            *((n, f"count(*) - count({c})") for n, c in (
                ("ID", "id"), ("Start_Time", "start_time"), ("City", "city"), ("State", "state"), ("Airport_Code", "airport_code"),
                ("Description", "description"), ("Severity", "severity"), ("Temperature(F)", "temperature"), ("Distance(mi)", "distance"),
                ("Wind_Speed(mph)", "wind_speed"), ("Precipitation(in)", "precipitation"), ("Weather_Condition", "weather_condition"),
                ("Weather_Timestamp", "weather_timestamp"))),
            ("End_Time", "count(*)"), ("Timezone", "count(*)"),
        )],
        *[f"select 'cast_{name}', 'raw_accidents', count(*), true from raw_acc where {c} is not null and try_cast({expr} as {kind}) is null"
          for name, c, expr, kind in (
            ("Start_Time", "start_time", "start_time", "date"), ("Weather_Timestamp", "weather_timestamp", "substr(weather_timestamp, 1, 10)", "date"),
            ("Severity", "severity", "severity", "int"), ("Distance(mi)", "distance", "distance", "double"),
            ("Temperature(F)", "temperature", "temperature", "double"), ("Wind_Speed(mph)", "wind_speed", "wind_speed", "double"),
            ("Precipitation(in)", "precipitation", "precipitation", "double"))],
        "select 'duplicate_keys', 'raw_cities', count(*), true from (select city, state from raw_city group by city, state having count(*) > 1) k",
        "select 'conflicting_duplicates', 'raw_cities', count(*), true from (select city, state from raw_city group by city, state "
        "having count(*) > 1 and count(distinct total_population) > 1) k",
    ]),
    "stream_refresh": "select year, month, count(*) as n from accidents group by year, month",
    "lasting_city_keys": (
        "select cast(row_number() over (order by c.city_name = 'AUTOMOBILE', c.city_name, c.state) - 1 as bigint) as city_id, "
        "c.city_name, c.state, count(a.accident_id) as n from cities c left join accidents a on a.city_id = c.city_id "
        "group by c.city_name, c.state"
    ),
    "refresh_last_writer": "select accident_id, severity, description from accidents",
    "mart_refresh": (
        "select 'by_city' as mart, c.city_name as key, c.state, count(*) as n from accidents a join cities c on a.city_id = c.city_id "
        "group by c.city_name, c.state union all select 'by_airport', airport_code, null, count(*) from accidents group by airport_code "
        "union all select 'by_weather', w.condition, null, count(*) from accidents a "
        "left join weather_conditions w on a.weather_condition_id = w.weather_condition_id group by w.condition"
    ),
    "build_airports": "select airport_code, state, state_code, type, name, municipality from airports",
    "build_cities": "select city_id, city_name, state, state_code, total_population from cities",
    "build_weather": "select weather_condition_id, condition from weather_conditions",
    "build_accidents": (
        "select accident_id, year, month, datetime, severity, distance, description, airport_code, city_id, weather_condition_id "
        "from accidents"
    ),
}


def _needed(sql: str) -> list[str]:
    want: set[str] = set()
    stack = [v for v in VIEWS if re.search(rf"(?<![\w']){v}(?![\w'])", sql)]
    while stack:
        v = stack.pop()
        if v not in want:
            want.add(v)
            stack.extend(DEPENDS.get(v, []))
    return [v for v in VIEWS if v in want]


def with_views(sql: str) -> str:
    views = _needed(sql)
    if not views:
        return sql
    return "with " + ", ".join(f"{v} as ({VIEWS[v]})" for v in views) + " " + sql


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in QUERIES.items()}
