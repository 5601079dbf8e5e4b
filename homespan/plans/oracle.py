"""SQL that answers the same questions on another engine (DuckDB), written independently.

Shared relations are common table expressions; ``sql(...)`` puts the ones a
query needs in front of it.
"""

from __future__ import annotations

from homespan.functions import values as V
from homespan.plans.catalog import AS_OF, CORRELATED, NOW
from homespan.plans.inputs import CENTROIDS, VALID_REGIONS

ORACLE: dict[str, str] = {}


def r(x: str, places: int = 6) -> str:
    return f"round_even(({x}) * 1e{places}, 0) / 1e{places}"


def text_list(names) -> str:
    return ", ".join("'" + n + "'" for n in names)


def uniform(field: str, key: str = "property_id") -> str:
    return f"(('0x' || substr(md5({key} || ':{field}'), 1, 8))::bigint / 4294967296.0)"


def normal(field: str) -> str:
    return f"(sqrt(-2.0 * ln(1.0 - {uniform(field + ':r')})) * cos(2.0 * pi() * {uniform(field + ':a')}))"


def clip(x: str, lo: float, hi: float) -> str:
    return f"least(greatest({x}, {lo}), {hi})"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}

CTE["properties"] = ((), """
select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as property_id,
  r_name as borough,
  cast(4040 + c_custkey % 50 as double) / 100 as lat,
  cast(-7430 + floor(c_custkey / 50) % 60 as double) / 100 as lng,
  cast(l_quantity as bigint) as sqft,
  cast(1 + l_partkey % 60 as bigint) as lot_sqft,
  cast(1900 + l_partkey % 124 as int) as year_built,
  case when l_linenumber = 7 and l_partkey % 3 = 0 then 12 else l_linenumber end as num_units,
  cast(1 + l_suppkey % 6 as int) as num_floors,
  p_type as building_class,
  cast(20 + (c_custkey * 29) % 80 as double) as walk_score,
  cast(10 + (l_suppkey * 23) % 90 as double) as transit_score,
  cast((c_custkey * 31) % 100 as double) as bike_score,
  cast(50 + (l_partkey * 97) % 4950 as bigint) as nearest_subway_m,
  cast(50 + (l_suppkey * 89) % 3950 as bigint) as nearest_park_m,
  cast(1 + (c_custkey * 7) % 60 as double) as crime_rate_per_1k,
  cast(1 + (l_suppkey * 3) % 9 as double) as school_quality_score,
  cast(20000 + (c_custkey * 373) % 300000 as bigint) as median_household_income,
  cast(1000 + (c_custkey * 211) % 109000 as bigint) as population_density,
  case when l_returnflag = 'R' then 1 else 0 end as flood_zone_flag,
  l_extendedprice as price,
  l_extendedprice / l_quantity as price_per_sqft,
  cast(year(l_shipdate) as int) as sale_year,
  cast(quarter(l_shipdate) as int) as sale_quarter,
  l_shipdate as sale_date,
  c_custkey as buyer_key,
  l_partkey as item_key
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
join part on l_partkey = p_partkey""")

CTE["keyed"] = (("properties",), f"""
select *, concat_ws('_', coalesce(borough, 'nan'), coalesce(cast({r('lat', 2)} as varchar), 'nan'),
    coalesce(cast({r('lng', 2)} as varchar), 'nan')) as nta_proxy,
  case when num_units > 0 and num_units <= 1 then '1u' when num_units > 1 and num_units <= 2 then '2u'
       when num_units > 2 and num_units <= 4 then '3-4u' when num_units > 4 and num_units <= 8 then '5-8u'
       when num_units > 8 and num_units <= 1000 then '9+u' else 'nan' end as unit_bucket
from properties""")

CTE["peers"] = (("keyed",), """
select nta_proxy, unit_bucket, count(*) as peer_rows, round_even(median(price_per_sqft) * 1e9, 0) / 1e9 as peer_median,
  stddev_samp(price_per_sqft) as peer_std from keyed group by 1, 2""")

CTE["fill"] = (("peers",), """
select sum(peer_std * peer_rows) / sum(peer_rows) as std_fill from peers where peer_std is not null""")

CTE["boros"] = (("keyed",), """
select borough, round_even(median(price_per_sqft) * 1e9, 0) / 1e9 as b_median, stddev_samp(price_per_sqft) as b_std
from keyed where borough is not null group by 1""")

CTE["scored"] = (("keyed", "peers", "fill", "boros"), """
select keyed.*, peer_median as peer_median_ppsf, coalesce(peer_std, std_fill) as peer_std_ppsf,
  case when peer_rows < 5 then coalesce((price_per_sqft - b_median) / nullif(b_std, 0), 0)
       else coalesce((price_per_sqft - peer_median) / nullif(coalesce(peer_std, std_fill), 0), 0) end as peer_z
from keyed join peers using (nta_proxy, unit_bucket) cross join fill left join boros using (borough)""")

CTE["features"] = (("scored",), f"""
select *, cast(2024 - year_built as int) as building_age,
  {r('sqft / nullif(num_units, 0)', 2)} as sqft_per_unit,
  {r('price / nullif(num_units, 0)', 2)} as price_per_unit,
  {r('sqft / nullif(lot_sqft, 0)', 3)} as floor_area_ratio,
  {r('sqft / nullif(lot_sqft * greatest(num_floors, 1), 0)', 3)} as lot_coverage,
  {r('walk_score / 100 + transit_score / 100 + school_quality_score / 10 - crime_rate_per_1k / 80', 3)} as amenity_score,
  {r('ln(1 + nearest_subway_m)', 3)} as log_subway_dist,
  {r('ln(1 + nearest_park_m)', 3)} as log_park_dist,
  {r('sale_year - 2022 + (sale_quarter - 1) / 4', 3)} as market_cycle_index,
  cast(case when peer_z < -0.75 then 0 when peer_z > 0.75 then 2 else 1 end as int) as valuation_label,
  case when peer_z < -0.75 then 'undervalued' when peer_z > 0.75 then 'overvalued'
       else 'fairly_valued' end as valuation_label_name
from scored""")


def pct_rank(x: str) -> str:
    return (f"(rank() over (partition by nta_proxy order by {x}) "
            f"+ (count(*) over (partition by nta_proxy, {x}) - 1) / 2.0) / count({x}) over (partition by nta_proxy)")


CTE["interactions"] = (("properties",), """
select buyer_key as buyer_id, item_key as property_id,
  avg(cast(1 + least(4, floor((sqft - 1) / 10)) as double)) as rating from properties group by 1, 2""")
CTE["g"] = (("interactions",), "select avg(rating) as g from interactions")
CTE["um"] = (("interactions",), "select buyer_id, avg(rating) as u from interactions group by 1")
CTE["im"] = (("interactions",), "select property_id, avg(rating) as m from interactions group by 1")
CTE["active"] = (("interactions",), """
select buyer_id from (select buyer_id, count(*) as n from interactions group by 1) order by n desc, buyer_id limit 3""")

CTE["local"] = (("properties",), f"""
select * replace (case buyer_key % 6 {' '.join(f"when {i} then '{b}'" for i, b in enumerate(V.BOROUGHS))}
    else 'elsewhere' end as borough),
  case when buyer_key % 29 = 0 then null when buyer_key % 31 = 0 then '0' when buyer_key % 37 = 0 then ' 7030 '
       else cast(10001 + buyer_key % 173 as varchar) end as raw_zip
from properties""")
CTE["zipped"] = (("local",), """
select *, case when length(trim(coalesce(raw_zip, ''))) <= 5
               then case when lpad(trim(coalesce(raw_zip, '')), 5, '0') = '00000' then ''
                         else lpad(trim(coalesce(raw_zip, '')), 5, '0') end
               else trim(raw_zip) end as zip_code from local""")
CTE["zips"] = (("zipped",), """
select zip_code, arg_min(borough, property_id) as zip_borough from zipped where zip_code <> '' group by 1""")
CTE["profiles"] = ((), "select * from (values " + ", ".join(
    "('" + p[0] + "', " + ", ".join(f"cast({x} as double)" for x in p[1:]) + ")" for p in V.BOROUGH_PROFILES)
    + ") t(" + ", ".join(part.split()[0] for part in V.PROFILE_COLUMNS.split(", ")).replace("borough", "profile", 1) + ")")
CTE["bridge"] = ((), "select * from (values " + ", ".join(
    f"('{z}', {p})" for p, zs in V.PRECINCT_ZIPS.items() for z in zs) + ") t(zip_code, precinct)")
CTE["complaints"] = ((), """
select cast(1 + user_id % 34 as varchar) as addr_pct_cd, count(*) as n, 'current' as source
from events where event_type = 'purchase' group by 1""")
CTE["schools"] = ((), """
select s_name as dbn, case when s_suppkey % 17 = 0 then '00000'
  else cast(10001 + (s_suppkey * s_suppkey) % 60 as varchar) end as zip from supplier""")
CTE["census"] = ((), """
select cast(10001 + c_custkey % 150 as varchar) as zip,
  cast(case when (10001 + any_value(c_custkey % 150)) % 7 = 0 then -666666666
       else 20000 + (sum(c_custkey) * 37) % 100000 end as bigint) as income,
  cast(case when (10001 + any_value(c_custkey % 150)) % 11 = 0 then -1 else count(*) * 500 end as bigint) as people
from customer group by 1""")
CTE["walk"] = ((), """
select lat, lng, cast((c * 29) % 80 as double) as walk_score, cast((c * 23) % 90 as double) as transit_score,
  case when c % 5 = 0 then null else cast((c * 31) % 100 as double) end as bike_score
from (select cast(4040 + c_custkey % 50 as double) / 100 as lat,
        cast(-7430 + floor(c_custkey / 50) % 60 as double) / 100 as lng, min(c_custkey) as c
      from customer group by 1, 2) where 1 + c % 3 in (1, 2)""")
HOME = f"case when upper({{0}}) in ({text_list(V.BOROUGHS)}) then upper({{0}}) else 'BROOKLYN' end"
CTE["census_zip"] = (("zips", "census", "profiles"), f"""
select zip_code, cast(case when coalesce(nullif(income, 0), -1) < 0 then {clip('income_mean', 20000, 350000)}
    else income end as bigint) as median_household_income,
  cast(least(case when coalesce(nullif(people, 0), -1) < 0 then 50000 else people end * 12, 110000) as bigint)
    as population_density
from zips join census on lpad(zip, 5, '0') = zip_code join profiles on profile = {HOME.format('zip_borough')}""")
CTE["crime_zip"] = (("bridge", "complaints"), f"""
select zip_code, cast(coalesce(sum(n), 0) as bigint) as complaint_count, cast(count(distinct precinct) as int) as n_precincts,
  {clip(r('coalesce(sum(n), 0) / 50000.0 * 1000', 2), 1.0, 80.0)} as crime_rate_per_1k
from bridge left join complaints on addr_pct_cd = cast(precinct as varchar) group by 1""")
CTE["school_n"] = (("schools",), """
select zip as zip_code, count(*) as n_schools from schools where zip not in ('', '00000') group by 1""")
CTE["school_zip"] = (("zips", "school_n", "profiles"), f"""
select zip_code, coalesce(n_schools, 0) as n_schools,
  {clip(r("school_mean + case when coalesce(n_schools, 0) >= 5 then 1.0 when coalesce(n_schools, 0) >= 3 then 0.5 "
          "when coalesce(n_schools, 0) >= 1 then 0.0 else -1.0 end", 2), 1.0, 10.0)} as school_quality_score
from zips left join school_n using (zip_code) join profiles on profile = {HOME.format('zip_borough')}""")

CTE["landed"] = (("properties",), """
select property_id as address, case when buyer_key % 6 = 5 then '9' else cast(1 + buyer_key % 6 as varchar) end as borough_code,
  cast(10001 + buyer_key % 173 as varchar) as zip_code, cast(num_units as double) as num_units,
  case when item_key % 13 = 0 then null else cast(lot_sqft as double) end as lot_sqft,
  case when item_key % 11 = 0 then 0.0 else cast(sqft as double) end as sqft,
  case when item_key % 17 = 0 then null else cast(year_built as double) end as year_built, price,
  case when item_key % 19 = 0 then null else sale_date end as sale_date, building_class,
  item_key, buyer_key, sqft as real_sqft, lot_sqft as real_lot, year_built as real_year, num_units as real_units
from properties""")
CTE["canonical"] = (("landed",), """
select *, case borough_code when '1' then 'MANHATTAN' when '2' then 'BRONX' when '3' then 'BROOKLYN'
    when '4' then 'QUEENS' when '5' then 'STATEN ISLAND' end as borough,
  price / nullif(sqft, 0) as price_per_sqft from landed""")

CTE["judged"] = (("features",), f"""
select property_id, valuation_label as actual, case when p < 0.2 then 0 when p > 0.8 then 2 else 1 end as predicted, p
from (select *, {pct_rank('price_per_sqft')} as p from features)""")
CTE["cells"] = (("judged",), """select a.actual, p.predicted, coalesce(c.n, 0) as n
from (select unnest([0, 1, 2]) as actual) a cross join (select unnest([0, 1, 2]) as predicted) p
left join (select actual, predicted, count(*) as n from judged group by 1, 2) c
  on c.actual = a.actual and c.predicted = p.predicted""")


def per_class(cells: str) -> str:
    """Class metrics of an (actual, predicted, n) relation."""
    return f"""
select k as class, support, called, hit, coalesce(hit / nullif(called, 0), 0.0) as p, coalesce(hit / nullif(support, 0), 0.0) as rc,
  coalesce(2.0 * (hit / nullif(called, 0)) * (hit / nullif(support, 0))
           / nullif(hit / nullif(called, 0) + hit / nullif(support, 0), 0), 0.0) as f1
from (select k, coalesce(sum(n) filter (actual = k), 0) as support, coalesce(sum(n) filter (predicted = k), 0) as called,
        cast(coalesce(sum(n) filter (actual = k and predicted = k), 0) as double) as hit
      from {cells}, (select distinct unnest([actual, predicted]) as k from {cells} where n > 0) group by k)"""


CTE["classes"] = (("cells",), per_class("cells"))
CTE["label_cells"] = ((), "select quality as actual, toxic as predicted, count(*) as n from labels group by 1, 2")
CTE["label_classes"] = (("label_cells",), per_class("label_cells"))
CTE["stacked"] = (("judged",), """
select k as class, case when k = 0 then 1.0 - p when k = 2 then p else 1.0 - abs(2.0 * p - 1.0) end as score,
  case when actual = k then 1 else 0 end as pos from judged, (select unnest([0, 1, 2]) as k)""")

fit_columns = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in V.CONTENT_FEATURES)
CTE["fit"] = (("features",), f"select {fit_columns} from features")
CTE["vectors"] = (("features", "fit"), "select features.*, [" + ", ".join(
    f"({c} - m_{c}) / nullif(s_{c}, 0)" for c in V.CONTENT_FEATURES) + "] as v from features cross join fit")
CTE["seeds"] = (("vectors",), """
select property_id as seed_id, v as seed_v, borough as seed_borough, buyer_key as seed_buyer from vectors
qualify row_number() over (partition by borough order by price desc, property_id desc) = 1""")


def similar(k: int, where: str = "true", same: str = "true") -> str:
    return f"""
select seed_id, seed_buyer, property_id, item_key, similarity, cast(row_number() over (
    partition by seed_id order by similarity desc, property_id) as int) as rank
from (select seed_id, seed_buyer, property_id, item_key, {r('list_cosine_similarity(v, seed_v)', 9)} as similarity
      from vectors, seeds where property_id <> seed_id and {where} and {same})
qualify rank <= {k}"""


def wish(name: str, where: str, score: str, n: int) -> str:
    bonus = ("case valuation_label_name when 'undervalued' then 0.5 when 'fairly_valued' then 0.2 else 0.0 end")
    return f"""(select '{name}' as request, property_id, item_key, borough, price,
      {r(f'{score} + {bonus}', 9)} as preference_score from features where {where}
      order by preference_score desc, property_id limit {n})"""


def wishes(n: int) -> str:
    """The three preference requests, ranked."""
    parts = [
        wish("family", "price <= 60000 and borough = 'ASIA'",
             "0.0 + (1.0 - crime_rate_per_1k / 80.0) + school_quality_score / 10.0", n),
        wish("commuter", "price <= 40000 and num_units >= 3", "0.0 + walk_score / 100.0 + transit_score / 100.0", n),
        wish("bargain", "borough = 'EUROPE' and valuation_label_name = 'undervalued'",
             "0.0 + school_quality_score / 10.0", n)]
    return ("select *, cast(row_number() over (partition by request order by preference_score desc, property_id) as int) as rank "
            "from (" + " union all ".join(parts) + ")")


def hybrid(pool: str, request: str, score: str, buyer: str, n: int) -> str:
    """Blend a pool (CTE name) with the mean-mode rating of its buyer column."""
    def scaled(x: str) -> str:
        lo, hi = f"min({x}) over (partition by {request})", f"max({x}) over (partition by {request})"
        return f"(case when {hi} - {lo} < 1e-9 then 0.5 else ({x} - {lo}) / nullif({hi} - {lo}, 0) end)"
    return f"""
select *, cast(row_number() over (partition by {request} order by hybrid_score desc, property_id) as int) as place
from (select *, {r(f'0.6 * {scaled(score)} + (1.0 - 0.6) * {scaled("collab_score")}', 9)} as hybrid_score
      from (select pool.*, {r(clip('coalesce(u, g) + coalesce(m, g) - g', 1.0, 5.0), 9)} as collab_score
            from ({pool}) pool cross join g left join um on um.buyer_id = pool.{buyer}
            left join im on im.property_id = pool.item_key))
qualify place <= {n}"""


affinity_z = sorted({c for w in V.BUYER_PROFILES.values() for c in w})
CTE["zfit"] = (("features",), "select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in affinity_z) + " from features")
CTE["affinity"] = (("features", "zfit"), " union all ".join(
    f"select property_id, '{name}' as buyer_profile, "
    + r("0.0 + " + " + ".join(f"coalesce(({c} - m_{c}) / nullif(s_{c}, 0), 0.0) * {w}" for c, w in weights.items()), 9)
    + " as affinity from features cross join zfit" for name, weights in V.BUYER_PROFILES.items()))


def distance(centre) -> str:
    return r(" + ".join(f"({c} - {x}) * ({c} - {x})" for c, x in zip(V.CLUSTER_FEATURES, centre)))


CTE["clustered"] = (("features",), "select *, list_min([" + ", ".join(
    f"{{'d': {distance(c)}, 'k': {i}}}" for i, c in enumerate(CENTROIDS)) + "]) as best from features")


def sql(name: str, uses: str, body: str) -> None:
    """Register ``body`` with every relation it needs, in dependency order."""
    done: list[str] = []

    def need(cte: str) -> None:
        for dep in CTE[cte][0]:
            need(dep)
        if cte not in done:
            done.append(cte)
    for cte in uses.split():
        need(cte)
    head = ",\n".join(f"{c} as ({CTE[c][1]})" for c in done)
    ORACLE[name] = (f"with {head}\n" if head else "") + body.strip()


DAY = "strftime({0}, '%Y-%m-%d') as {0}"
FEATURES = ("building_age, sqft_per_unit, price_per_unit, floor_area_ratio, lot_coverage, amenity_score, "
            "log_subway_dist, log_park_dist, market_cycle_index")

# sources and sinks
sql("read_table", "properties", f"select * replace ({r('price_per_sqft')} as price_per_sqft, "
    "strftime(sale_date, '%Y-%m-%d') as sale_date) from properties")
sql("write_table", "properties", "select property_id, borough, price from properties")
sql("write_csv", "features", "select property_id, borough, sqft, valuation_label from features")
sql("read_csv", "properties", "select building_class, count(*) as n from properties group by 1")
sql("ingest", "properties", "select property_id, price from properties")
sql("read_sales_json", "landed", """
select borough_code as borough, address, zip_code, cast(real_units as varchar) as total_units,
  case when item_key % 13 = 0 then ' - ' else cast(real_lot as varchar) end as land_square_feet,
  case when item_key % 11 = 0 then '0' else cast(real_sqft as varchar) end as gross_square_feet,
  case when item_key % 17 = 0 then 'unknown' else cast(real_year as varchar) end as year_built from landed""")
sql("read_complaint_counts", "complaints", "select addr_pct_cd, n, source from complaints")
sql("read_school_directory", "schools", "select dbn, zip from schools")
sql("read_census", "census", "select zip, income, people from census")
sql("read_walk_scores", "walk", "select lat, lng, walk_score, transit_score, bike_score from walk")
sql("latest_fresh_snapshot", "", f"""
select event_id, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') as fetched_at from events
where date_trunc('hour', ts) = (select max(date_trunc('hour', ts)) from events
  where date_trunc('hour', ts) between timestamp '{NOW}' - interval 1 hour and timestamp '{NOW}')""")
sql("reference_dims", "local profiles", f"""
select borough, ppsf_mean, income_mean, count(*) as n from local join profiles on profile = {HOME.format('borough')}
group by 1, 2, 3""")
sql("data_freshness", "", f"""
select 'events' as dataset, count(*) as row_count, strftime(max(date_trunc('hour', ts)), '%Y-%m-%d') as last_update,
  cast(date_diff('day', cast(max(ts) as date), date '{NOW[:10]}') as bigint) as age_days,
  case when date_diff('day', cast(max(ts) as date), date '{NOW[:10]}') < 90 then 'fresh' else 'stale' end as state
from events""")

# projections
sql("canonicalize_sales", "canonical", f"""
select address, borough_code, borough, zip_code, num_units, lot_sqft, sqft, year_built, price,
  {r('price_per_sqft')} as price_per_sqft, {DAY.format('sale_date')} from canonical""")
sql("default_live_fields", "canonical", """
select address, cast(greatest(coalesce(num_units, 1), 1) as int) as num_units,
  cast(least(greatest(coalesce(year_built, 1970), 1800), 2024) as int) as year_built,
  cast(2024 - least(greatest(coalesce(year_built, 1970), 1800), 2024) as int) as building_age,
  cast(floor(greatest(coalesce(lot_sqft, sqft * 1.5), 500)) as bigint) as lot_sqft,
  cast(greatest(1, floor(greatest(coalesce(num_units, 1), 1) / 2)) as int) as num_floors, building_class from canonical""")
sql("derive_sale_period", "canonical", """
select address, cast(coalesce(year(sale_date), 2024) as int) as sale_year,
  cast(coalesce(quarter(sale_date), 1) as int) as sale_quarter from canonical""")
sql("assign_live_id", "canonical", """
select 'LIVE_' || md5(address) || '_' || cast(cast(trunc(price) as bigint) as varchar) as property_id,
  address, price from canonical""")
sql("engineer_features", "features", f"select property_id, {FEATURES} from features")
sql("assign_neighborhood", "keyed", "select property_id, nta_proxy from keyed")
sql("unit_bucket", "keyed", "select num_units, unit_bucket, count(*) as n from keyed group by 1, 2")
sql("select_features", "features", " union all ".join(
    f"select '{c}' as feature, count(*) as non_null from features" for c in [*V.MODEL_NUMERIC, *V.MODEL_CATEGORICAL]))
sql("project_existing", "properties", "select property_id, borough, price from properties")
sql("valuation_label", "features",
    f"select property_id, {r('peer_z')} as peer_z, valuation_label, valuation_label_name from features")

# filters
sql("recent_sales", "properties", f"""
select property_id, borough, price, {DAY.format('sale_date')} from
  (select * from properties where price > 20000 and borough = 'ASIA' and sale_date >= timestamp '1996-01-01'
   order by sale_date desc, property_id limit 500)""")
sql("topk_recent", "properties", f"""
select property_id, {DAY.format('sale_date')} from (select * from properties order by sale_date desc, property_id limit 100)""")
sql("sanity_filter", "properties", """
select property_id, price, sqft from properties where price >= 20000 and sqft >= 10 and price_per_sqft between 50 and 5000""")
sql("drop_null_critical", "canonical", """
select count(*) filter (price is not null and sqft is not null and price_per_sqft is not null and year_built is not null) as kept,
  count(*) filter (price is null or sqft is null or price_per_sqft is null or year_built is null) as dropped from canonical""")
sql("compare_properties", "features seeds", f"""
select property_id, borough, price, sqft, {r('price_per_sqft')} as price_per_sqft, num_units, walk_score, transit_score,
  school_quality_score, crime_rate_per_1k, valuation_label_name from features
where property_id in (select seed_id from seeds)""")
sql("preference_filter", "features", """
select property_id, price from features
where price <= 60000 and borough = 'ASIA' and num_units >= 3 and valuation_label_name = 'undervalued'""")
sql("similarity_filter", "features", """
select property_id, price from features where valuation_label = 0 and price <= 30000 and borough = 'EUROPE'""")
sql("relevant_set", "features", """
select property_id from features where valuation_label = 0 and price <= 60000 and borough = 'ASIA'""")

# joins
sql("enrich_hyperlocal", "zipped zips census_zip crime_zip school_zip profiles", f"""
select property_id, zip_code,
  cast(coalesce(c.median_household_income, {clip('income_mean', 20000, 350000)}) as bigint) as median_household_income,
  cast(coalesce(c.population_density, 25000) as bigint) as population_density,
  {r(f"coalesce(k.crime_rate_per_1k, {clip('crime_mean', 1, 80)})", 2)} as crime_rate_per_1k,
  {r(f"coalesce(s.school_quality_score, {clip('school_mean', 1, 10)})", 2)} as school_quality_score,
  case when c.median_household_income is null then 'borough_fallback' else 'census' end as census_source,
  case when k.crime_rate_per_1k is null then 'borough_fallback' else 'crime' end as crime_source,
  case when s.school_quality_score is null then 'borough_fallback' else 'school' end as school_source
from zipped left join zips using (zip_code) left join census_zip c using (zip_code)
left join crime_zip k on k.zip_code = zips.zip_code left join school_zip s on s.zip_code = zips.zip_code
join profiles on profile = {HOME.format('coalesce(zip_borough, borough)')}""")
sql("normalize_zip", "zipped", "select property_id, zip_code from zipped")
sql("zip_borough", "zips", "select zip_code, zip_borough from zips")
sql("precinct_zip_bridge", "bridge complaints", """
select zip_code, precinct, n from complaints join bridge on addr_pct_cd = cast(precinct as varchar)""")
sql("crime_rate_by_zip", "crime_zip", "select zip_code, complaint_count, n_precincts, crime_rate_per_1k from crime_zip")
sql("school_score_by_zip", "school_zip", "select zip_code, n_schools, school_quality_score from school_zip")
sql("census_by_zip", "census_zip", "select zip_code, median_household_income, population_density from census_zip")
sql("walk_score_lookup", "local walk profiles", f"""
select property_id,
  {r(f"coalesce(nullif(w.walk_score, 0), {clip('walk_mean', 10, 100)})", 1)} as walk_score,
  {r(f"coalesce(nullif(w.transit_score, 0), {clip('transit_mean', 5, 100)})", 1)} as transit_score,
  {r(f"coalesce(nullif(w.bike_score, 0), {clip('walk_mean - 5', 0, 100)})", 1)} as bike_score,
  case when w.walk_score is not null then 'walk_scores' else 'borough_fallback' end as walk_source
from local left join walk w using (lat, lng) join profiles on profile = {HOME.format('borough')}""")
sql("borough_profile_lookup", "local profiles", f"""
select property_id, ppsf_mean, income_mean, walk_mean, school_mean from local join profiles on profile = {HOME.format('borough')}""")

FALLBACKS = {"walk_score": ("walk_mean", "walk_std"), "transit_score": ("transit_mean", "transit_std"),
             "bike_score": ("walk_mean - 5", "15"), "crime_rate_per_1k": ("crime_mean", "crime_std"),
             "school_quality_score": ("school_mean", "school_std"), "median_household_income": ("income_mean", "income_std"),
             "population_density": ("25000", "12000")}
sql("hyperlocal_fallback", "local profiles", "select property_id, " + ", ".join(
    f"cast({clip(m, *V.FALLBACK_LIMITS[f])} as double) as fallback_{f}" for f, (m, s) in FALLBACKS.items())
    + f" from local join profiles on profile = {HOME.format('borough')}")
sql("hyperlocal_fallback_draw", "local profiles", "select property_id, " + ", ".join(
    f"{r(clip(f'{m} + {s} * {normal(f)}', *V.FALLBACK_LIMITS[f]))} as fallback_{f}" for f, (m, s) in FALLBACKS.items())
    + f" from local join profiles on profile = {HOME.format('borough')}")
sql("neighborhood_median_join", "keyed", f"""
select property_id, {r(r('median(price_per_sqft) over (partition by nta_proxy)', 9))} as ppsf_neighborhood_median from keyed""")
sql("label_lookup", "features", """
select property_id, valuation_label_name as label_name,
  case valuation_label when 0 then 0.5 when 1 then 0.2 else 0.0 end::double as label_bonus from features""")
sql("unseen_items", "interactions active", """
select p_partkey as property_id from part where p_partkey not in
  (select property_id from interactions where buyer_id = (select buyer_id from active limit 1))""")
sql("rating_lookup", "properties um im g", f"""
select distinct p.buyer_key as buyer_id, p.item_key + 7 as property_id,
  {r(r(clip('coalesce(u, g) + coalesce(m, g) - g', 1.0, 5.0), 9))} as predicted_rating
from properties p cross join g left join um on um.buyer_id = p.buyer_key left join im on im.property_id = p.item_key + 7""")
sql("similarity_join", "vectors seeds",
    f"select seed_id, property_id, {r('similarity')} as similarity, rank from ({similar(20)})")

# aggregations
SHARES = ", ".join(
    f"{r(f'count(*) filter (valuation_label = {i}) / count(*)', 3)} as share_{n}" for i, n in V.LABEL_NAMES.items())
PPSF = r(r("median(price_per_sqft)", 9), 2)
sql("neighborhood_profile", "features", f"""
select borough, count(*) as n_properties, cast(floor(median(price)) as bigint) as median_price, {PPSF} as median_price_per_sqft,
  {r('median(walk_score)', 1)} as median_walk_score, {r('median(transit_score)', 1)} as median_transit_score,
  {r('median(school_quality_score)', 2)} as median_school_quality_score,
  {r('median(crime_rate_per_1k)', 2)} as median_crime_rate_per_1k,
  cast(floor(median(median_household_income)) as bigint) as median_household_income, {SHARES}
from features group by 1""")
sql("market_summary", "features", " union all ".join(f"""
select {b} as borough, count(*) as total_properties, cast(floor(median(price)) as bigint) as median_price,
  {PPSF} as median_ppsf, {SHARES} from features {g}""" for b, g in (("'all'", ""), ("borough", "group by borough"))))
sql("live_market_summary", "properties", " union all ".join(f"""
select {b} as borough, count(*) as n, cast(floor(median(price)) as bigint) as median_price, {PPSF} as median_ppsf,
  strftime(min(sale_date), '%Y-%m-%d') as earliest, strftime(max(sale_date), '%Y-%m-%d') as latest from properties
where sale_date between timestamp '{AS_OF}' - interval 900 day and timestamp '{AS_OF}' {g}"""
    for b, g in (("'all'", ""), ("borough", "group by borough"))))
sql("label_distribution", "features", f"""
select borough, valuation_label_name, count(*) as n,
  {r('count(*) / sum(count(*)) over (partition by borough)', 3)} as share from features group by 1, 2""")
sql("borough_medians", "properties", "select borough, " + ", ".join(
    f"{r(r(f'median({c})', 9))} as {c}" for c in ("price", "price_per_sqft", "sqft", "walk_score", "crime_rate_per_1k",
                                            "school_quality_score")) + " from properties group by 1")
sql("price_trend", "properties", f"""
select sale_year, borough, {r(r('median(price_per_sqft)', 9))} as median_ppsf from properties group by 1, 2""")
sql("value_counts", "properties", "select borough, count(*) as n from properties group by 1")

NUMBERS = ["lat", "lng", "sqft", "lot_sqft", "year_built", "num_units", "num_floors", "walk_score", "transit_score",
           "bike_score", "nearest_subway_m", "nearest_park_m", "crime_rate_per_1k", "school_quality_score",
           "median_household_income", "population_density", "flood_zone_flag", "price", "price_per_sqft", "sale_year",
           "sale_quarter", "building_age", "sqft_per_unit", "price_per_unit", "floor_area_ratio", "lot_coverage",
           "amenity_score", "log_subway_dist", "log_park_dist", "market_cycle_index", "peer_median_ppsf",
           "peer_std_ppsf", "peer_z", "valuation_label"]
TEXTS = ["property_id", "borough", "building_class", "nta_proxy", "unit_bucket", "valuation_label_name"]
sql("describe_table", "features", " union all ".join([f"""
select '{c}' as "column", count({c}) as count, cast(null as bigint) as "unique", cast(null as varchar) as top,
  cast(null as bigint) as freq, {r(r(f'avg({c})', 9))} as mean, {r(r(f'stddev_samp({c})', 9))} as std, {r(f'min({c})')} as min,
  {r(r(f'quantile_cont({c}, 0.25)', 9))} as q25, {r(r(f'quantile_cont({c}, 0.5)', 9))} as q50, {r(r(f'quantile_cont({c}, 0.75)', 9))} as q75,
  {r(f'max({c})')} as max from features""" for c in NUMBERS] + [f"""
select '{c}', cast(sum(n) as bigint), count(*), arg_min(v, (-n, v)), max(n), null, null, null, null, null, null, null
from (select {c} as v, count(*) as n from features group by 1)""" for c in TEXTS]))
sql("count_neighborhoods", "keyed", "select count(distinct nta_proxy) as n_neighborhoods from keyed")
sql("school_counts", "school_n", "select zip_code, n_schools from school_n")
sql("correlation_matrix", "features", " union all ".join(
    f"select '{a}' as a, '{b}' as b, {r(r(f'corr({a}, {b})', 9))} as r from features" for a in CORRELATED for b in CORRELATED))
sql("missingness", "canonical", 'select * from (' + " union all ".join(
    f"""select '{c}' as "column", {r(f'avg(case when {c} is null then 1.0 else 0.0 end)')} as null_share from canonical"""
    for c in ("borough", "sqft", "lot_sqft", "year_built", "price", "price_per_sqft", "sale_date")) + ") where null_share > 0")


def histogram(x: str, bins: int) -> str:
    width = f"((hi - lo) / {bins}.0)"
    return f"""
select cast(bin as int) as bin, {r(f'lo + {width} * bin')} as from_value, {r(f'lo + {width} * (bin + 1)')} as to_value, count(*) as n
from (select lo, hi, least(floor(coalesce((x - lo) / nullif({width}, 0), 0)), {bins - 1}) as bin
      from (select {x} as x, min({x}) over () as lo, max({x}) over () as hi from features)) group by bin, lo, hi"""


sql("histogram", "features", histogram("price / 1e6", 60))
sql("histogram_log", "features", histogram("log10(price)", 60))
sql("histogram_z", "features", histogram("least(greatest(peer_z, -3.0), 3.0)", 80))
sql("boxplot_stats", "features", f"""
select borough, {r(r('q1', 9))} as q1, {r(r('q2', 9))} as median, {r(r('q3', 9))} as q3, {r('min(price_per_sqft)')} as whisker_lo,
  {r('max(price_per_sqft)')} as whisker_hi
from features join (select borough, quantile_cont(price_per_sqft, 0.25) as q1, quantile_cont(price_per_sqft, 0.5) as q2,
  quantile_cont(price_per_sqft, 0.75) as q3 from features group by 1) using (borough)
where price_per_sqft between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) group by borough, q1, q2, q3""")
sql("rating_means", "interactions", f"""
select 'buyer' as kind, cast(buyer_id as varchar) as key, {r('avg(rating)')} as mean_rating, count(*) as n from interactions group by 2
union all select 'property', cast(property_id as varchar), {r('avg(rating)')}, count(*) from interactions group by 2
union all select 'all', 'all', {r('avg(rating)')}, count(*) from interactions""")
PROFILE = ", ".join(f"{r(r(f'median({c})', 9), 2)} as {c}" for c in V.CLUSTER_PROFILE_COLUMNS)
sql("cluster_profiles", "clustered", f"""
select best.k as cluster, {PROFILE}, count(*) as n_properties from clustered group by 1""")
sql("confusion_matrix", "cells", """
select actual, cast(sum(n) filter (predicted = 0) as bigint) as predicted_0, cast(sum(n) filter (predicted = 1) as bigint) as predicted_1,
  cast(sum(n) filter (predicted = 2) as bigint) as predicted_2 from cells group by 1""")
sql("std_fill", "fill", f"select {r('std_fill')} as std_fill from fill")

# windows
sql("neighborhood_percentiles", "keyed", "select property_id, " + ", ".join(
    f"{r(pct_rank(x))} as {n}_neighborhood_percentile" for x, n in (
        ("price_per_sqft", "ppsf"), ("crime_rate_per_1k", "crime"), ("school_quality_score", "school"),
        ("median_household_income", "income"))) + " from keyed")
sql("peer_stats", "peers", f"""
select nta_proxy, unit_bucket, peer_rows, {r('peer_median')} as peer_median_ppsf, {r('peer_std')} as peer_std from peers""")
sql("peer_zscore", "scored", f"""
select property_id, {r('peer_median_ppsf')} as peer_median_ppsf, {r('peer_std_ppsf')} as peer_std_ppsf,
  {r('peer_z')} as peer_z from scored""")
sql("standardize", "properties", "select property_id, " + ", ".join(
    f"{r(f'({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0)')} as z_{c}"
    for c in ("sqft", "walk_score", "crime_rate_per_1k", "price_per_sqft")) + " from properties")
sql("minmax", "features", f"""
select request, property_id, {r('''case when max(preference_score) over (partition by request) - min(preference_score) over (partition by request) < 1e-9
  then 0.5 else (preference_score - min(preference_score) over (partition by request))
  / nullif(max(preference_score) over (partition by request) - min(preference_score) over (partition by request), 0) end''')} as scaled
from ({wishes(200)})""")
sql("rank_within_request", "keyed", """
select nta_proxy, property_id, price, cast(row_number() over (partition by nta_proxy order by price desc, property_id) as int) as rank
from keyed qualify rank <= 3""")

# sorts, limits, samples
sql("topk_similar", "vectors seeds",
    f"select seed_id, property_id, {r('similarity')} as similarity, rank from ({similar(10)})")
sql("topk_preference", "features",
    f"select request, rank, property_id, {r('preference_score')} as preference_score from ({wishes(25)})")
TOP_AFFINITY = ("cast(row_number() over (partition by buyer_profile order by affinity desc, property_id) as int) as rank")
sql("nlargest", "affinity", f"select buyer_profile, {TOP_AFFINITY}, property_id from affinity qualify rank <= 15")
sql("boroughs_by_median", "features", f"""
select borough, {r('median_ppsf')} as median_ppsf,
  cast(row_number() over (order by median_ppsf desc, borough) as int) as position
from (select borough, round_even(median(price_per_sqft) * 1e9, 0) / 1e9 as median_ppsf from features group by 1)""")
SAMPLED = "(select * from features order by md5(property_id), property_id limit {0})"
sql("sample_n", "features", f"select property_id, price from {SAMPLED.format(1000)}")

# sets and shapes
sql("union_sources", "properties", """
select property_id, borough, price, 'live_nyc_dof' as data_source from properties where year(sale_date) >= 1998
union all select property_id, borough, price, 'synthetic' from properties where year(sale_date) < 1998""")
sql("union_sources_target", "properties", """
select property_id, borough, price, 'live_nyc_dof' as data_source from properties where year(sale_date) >= 1998
union all select property_id, borough, price, 'synthetic' from (
  select * from properties where year(sale_date) < 1998 qualify row_number() over (order by md5(property_id), property_id)
    <= (select count(*) * 3 // 4 - count(*) filter (year(sale_date) >= 1998) from properties))""")
sql("invalid_values", "local", f"""
select distinct borough from local where borough is not null and borough not in ({text_list(V.BOROUGHS)})""")
sql("merge_candidates", "affinity", """
select buyer_profile, property_id, source, cast(row_number() over (
    partition by buyer_profile order by source, property_id) as int) as place
from (select buyer_profile, property_id, min(source) as source from (
    select buyer_profile, property_id, 0 as source from affinity
    qualify row_number() over (partition by buyer_profile order by affinity desc, property_id) <= 15
    union all select * from (select buyer_profile, property_id, 1 as source from affinity
    qualify row_number() over (partition by buyer_profile order by md5(buyer_profile || property_id)) <= 15))
  group by 1, 2) qualify place <= 30""")
METRICS = f"""
select {r('sum(hit) / sum(support)')} as accuracy, {r('avg(f1)')} as f1_macro,
  {r('sum(f1 * support) / sum(support)')} as f1_weighted, {r('avg(p)')} as precision_macro, {r('avg(rc)')} as recall_macro,
  {r('''(sum(hit) / sum(support) - sum(cast(support as double) * called) / (sum(support) * cast(sum(support) as double)))
    / nullif(1 - sum(cast(support as double) * called) / (sum(support) * cast(sum(support) as double)), 0)''')} as cohen_kappa
from """
sql("melt_metrics", "classes", f"""
select 'percentile' as model, metric, value from (unpivot (select accuracy, f1_macro, f1_weighted, cohen_kappa
  from ({METRICS} classes)) on accuracy, f1_macro, f1_weighted, cohen_kappa into name metric value value)""")

# quality
BAD_PRICE = "case when item_key % 23 = 0 then -1.0 else price end"


def rules(valid: list[str]) -> list[tuple[str, str]]:
    out = []
    for c, (kind, lo, hi) in V.PROPERTY_RULES.items():
        x = BAD_PRICE if c == "price" else c
        if c == "bike_score":
            out.append((f"{c}:column_present", "true"))
            continue
        out.append((f"{c}:not_null", f"({x}) is null"))
        if kind == "borough":
            out.append((f"{c}:allowed", f"{x} not in ({text_list(valid)})"))
        elif kind == "flag":
            out.append((f"{c}:allowed", f"{x} not in (0, 1)"))
        elif kind == "gt":
            out.append((f"{c}:above", f"{x} <= {lo}"))
        elif kind == "range":
            parts = ([f"{x} < {lo}"] if lo is not None else []) + ([f"{x} > {hi}"] if hi is not None else [])
            out.append((f"{c}:range", " or ".join(parts)))
    return out


sql("validate_properties", "properties", " union all ".join(
    f"select '{n}' as rule, count(*) filter ({c}) as failures from properties" for n, c in rules(VALID_REGIONS[:4])))
sql("failure_cases", "properties", "select * from (" + " union all ".join(
    f"select property_id, '{n}' as rule from properties where {c}" for n, c in rules(VALID_REGIONS)
    if not n.startswith("bike_score")) + ") order by property_id, rule limit 20")
sql("validate_basic", "properties", " union all ".join(
    f"select '{n}' as \"check\", coalesce(bool_or({c}), false) as failed from properties" for n, c in [
        *((f"missing:{c}", "true" if c == "lng" else "false") for c in
          ("property_id", "borough", "lat", "lng", "sqft", "price")),
        ("invalid_borough", f"borough not in ({text_list(VALID_REGIONS[:4])})"), ("non_positive:price", "price <= 0"),
        ("non_positive:sqft", "sqft <= 0"), ("latitude_bounds", "not coalesce(lat between 40.4 and 40.95, false)")]))
sql("feature_sanity_corr", "properties", " union all ".join(
    f"select '{c}' as feature, {r(f'corr(price_per_sqft, {c})')} as r, {s} as expected_sign, "
    f"sign(corr(price_per_sqft, {c})) = {s} as as_expected from properties"
    for c, s in (("walk_score", 1), ("school_quality_score", 1), ("crime_rate_per_1k", -1))))
sql("label_consistency", "features", """
select count(*) filter (['undervalued', 'fairly_valued', 'overvalued'][valuation_label + 1] is distinct from valuation_label_name)
  as mismatches, count(distinct valuation_label) as classes from features""")

# evaluation
sql("classifier_metrics", "classes", METRICS + "classes")
sql("classifier_metrics_labels", "label_classes", METRICS + "label_classes")
sql("classification_report", "classes", f"""
select cast(class as varchar) as row, {r('p')} as precision, {r('rc')} as recall, {r('f1')} as f1, cast(support as bigint) as support from classes
union all select 'accuracy', {r('sum(hit) / sum(support)')}, {r('sum(hit) / sum(support)')}, {r('sum(hit) / sum(support)')},
  cast(sum(support) as bigint) from classes
union all select 'macro avg', {r('avg(p)')}, {r('avg(rc)')}, {r('avg(f1)')}, cast(sum(support) as bigint) from classes
union all select 'weighted avg', {r('sum(p * support) / sum(support)')}, {r('sum(rc * support) / sum(support)')},
  {r('sum(f1 * support) / sum(support)')}, cast(sum(support) as bigint) from classes""")
AUC = """
select class, (sum(avg_rank) filter (pos = 1) - count(*) filter (pos = 1) * (count(*) filter (pos = 1) + 1) / 2.0)
  / (cast(count(*) filter (pos = 1) as double) * count(*) filter (pos = 0)) as auc, count(*) filter (pos = 1) as positives
from (select class, pos, rank() over (partition by class order by score)
        + (count(*) over (partition by class, score) - 1) / 2.0 as avg_rank from stacked) group by 1"""
sql("roc_auc_ovr", "stacked", f"""
select class, {r('auc')} as auc, positives from ({AUC})
union all select -1, {r('sum(auc * positives) / sum(positives)')}, cast(sum(positives) as bigint) from ({AUC})""")
sql("roc_curve", "stacked", f"""
select class, {r('score', 9)} as threshold, {r('fp / nn')} as fpr, {r('tp / pp')} as tpr from (
  select class, score, sum(sum(1 - pos)) over w as fp, sum(sum(pos)) over w as tp,
    sum(sum(1 - pos)) over (partition by class) as nn, sum(sum(pos)) over (partition by class) as pp
  from stacked group by class, score window w as (partition by class order by score desc))""")
RELEVANT = "(select property_id from features where valuation_label = 0 and price <= 60000 and borough = 'EUROPE')"
sql("recommender_metrics", "features", f"""
select request, k, {r('hits / k')} as precision, {r('case when total > 0 then hits / nullif(total, 0) else 0 end')} as recall,
  {r('''case when total > 0 then dcg / list_sum([1.0 / log2(i + 1) for i in range(1, cast(least(k, total) as int) + 1)]) else 0 end''')} as ndcg
from (select request, k, count(*) filter (rank <= k and hit) as hits,
        coalesce(sum(1.0 / log2(rank + 1)) filter (rank <= k and hit), 0) as dcg, (select count(*) from {RELEVANT}) as total
      from (select *, property_id in {RELEVANT} as hit from ({wishes(20)})), (select unnest([5, 10, 20]) as k) group by 1, 2)""")
sql("catalog_coverage", "features", f"""
select count(distinct property_id) as recommended, (select count(*) from features) as catalogue,
  {r('count(distinct property_id) / (select count(*) from features)')} as coverage from ({wishes(20)})""")

# recommendation
sql("content_features", "vectors", "select property_id, " + ", ".join(
    f"{r(f'v[{i + 1}]')} as {c}" for i, c in enumerate(V.CONTENT_FEATURES)) + " from vectors")
sql("recommend_similar", "vectors seeds", f"""
select seed_id, property_id, {r('similarity')} as similarity, rank
from ({similar(10, "valuation_label = 0 and price <= 60000", "borough = seed_borough")})""")
sql("recommend_from_preferences", "features", f"""
select request, rank, property_id, borough, price, {r('preference_score')} as preference_score from ({wishes(10)})""")
RATING = "cast(least(greatest(round_even(3.0 + affinity, 0), 1), 5) as int) as rating"
sql("profile_affinity", "affinity", f"select property_id, buyer_profile, {r('affinity')} as affinity, {RATING} from affinity")
sql("top_affinity", "affinity", f"select buyer_profile, {TOP_AFFINITY}, property_id, {RATING} from affinity qualify rank <= 30")
sql("predict_user_item_mean", "interactions um im g", f"""
select i.buyer_id, i.property_id, {r(r(clip('u + m - g', 1.0, 5.0), 9))} as predicted_rating
from interactions i cross join g join um using (buyer_id) join im on im.property_id = i.property_id""")


def for_buyers(n: int) -> str:
    return f"""
select buyer_id, property_id, {r('predicted_rating')} as predicted_rating, cast(row_number() over (
    partition by buyer_id order by predicted_rating desc, property_id) as int) as rank
from (select a.buyer_id, p_partkey as property_id, {r(clip('coalesce(u, g) + coalesce(m, g) - g', 1.0, 5.0), 9)} as predicted_rating
      from active a cross join part cross join g left join um using (buyer_id) left join im on im.property_id = p_partkey
      where (a.buyer_id, p_partkey) not in (select (buyer_id, property_id) from interactions)) qualify rank <= {n}"""


sql("recommend_for_buyer", "active um im g interactions", for_buyers(10))
sql("topk_predicted", "active um im g interactions", for_buyers(50))
HYBRID = f"""
select seed_buyer as buyer_id, seed_id, place as rank, property_id, {r('similarity')} as similarity,
  {r('collab_score')} as collab_score, {r('hybrid_score')} as hybrid_score from """
sql("recommend_hybrid", "vectors seeds um im g",
    HYBRID + f"({hybrid(similar(200, 'valuation_label = 0'), 'seed_id', 'similarity', 'seed_buyer', 10)})")
sql("topk_hybrid", "vectors seeds um im g",
    HYBRID + f"({hybrid(similar(200), 'seed_id', 'similarity', 'seed_buyer', 25)})")
WISH_POOL = f"select *, 7 as buyer from ({wishes(200)})"
sql("recommend_hybrid_preferences", "features um im g", f"""
select request, place as rank, property_id, {r('preference_score')} as preference_score, {r('collab_score')} as collab_score,
  {r('hybrid_score')} as hybrid_score from ({hybrid(WISH_POOL, 'request', 'preference_score', 'buyer', 10)})""")

# clusters
sql("assign_clusters", "clustered", f"select property_id, best.k as cluster, {r('best.d')} as distance2 from clustered")
sql("name_clusters", "clustered", f"""
select cluster, concat_ws('_', case when price_per_sqft > 1200 then 'Luxury' when price_per_sqft > 700 then 'MidTier' else 'Affordable' end,
  case when walk_score > 85 then 'HighlyWalkable' when walk_score < 60 then 'CarOriented' end,
  case when crime_rate_per_1k < 15 then 'LowCrime' when crime_rate_per_1k > 35 then 'HighCrime' end,
  case when school_quality_score > 7 then 'TopSchools' end) as cluster_name
from (select best.k as cluster, {PROFILE} from clustered group by 1)""")
CTE["points"] = ((), "select vec_id, cast(embedding as double[]) as v, label from embeddings order by md5(cast(vec_id as varchar)), vec_id limit 5000")
sql("silhouette", "points", f"""
select count(*) as n, {r('avg(s)')} as silhouette from (
  select vec_id, case when any_value(own_n) > 1 then (min(other) - any_value(own)) / greatest(min(other), any_value(own)) else 0 end as s
  from (select vec_id, l1, sum(d) filter (l2 = l1) over (partition by vec_id) / nullif(max(n) filter (l2 = l1) over (partition by vec_id) - 1, 0) as own,
          max(n) filter (l2 = l1) over (partition by vec_id) as own_n, case when l2 <> l1 then d / n end as other
        from (select a.vec_id, a.label as l1, b.label as l2, sum(list_distance(a.v, b.v)) as d, count(*) as n
              from points a, points b group by 1, 2, 3)) group by vec_id)""")

# maps and plots
sql("heatmap_weights", "features", f"""
select property_id, lat, lng, {r(clip('(x - lo) / nullif(hi - lo, 0)', 0.0, 1.0))} as weight
from (select *, price_per_sqft as x, quantile_cont(price_per_sqft, 0.02) over () as lo, quantile_cont(price_per_sqft, 0.98) over () as hi
      from {SAMPLED.format(8000)})""")
sql("heatmap_weights_undervalued", "features",
    f"select property_id, lat, lng, 1.0::double as weight from {SAMPLED.format(8000)} where valuation_label = 0")
sql("map_points", "features", f"""
select property_id, lat, lng, price, {r('price_per_sqft')} as price_per_sqft, valuation_label_name as colour_key from {SAMPLED.format(5000)}""")
sql("recommendation_points", "vectors seeds", f"""
select seed_id, 0 as rank, seed_id as property_id, lat, lng, price, borough from seeds join features on property_id = seed_id
union all select s.seed_id, s.rank, s.property_id, lat, lng, price, borough from ({similar(10)}) s join features using (property_id)""")
sql("scatter_sample", "features", f"""
select property_id, borough, walk_score, {r('price_per_sqft')} as price_per_sqft from {SAMPLED.format(10000)}""")
sql("impute_coordinates", "local profiles", f"""
select property_id, {r(f"lat_lo + (lat_hi - lat_lo) * {uniform('lat')}")} as lat,
  {r(f"lng_lo + (lng_hi - lng_lo) * {uniform('lng')}")} as lng from local join profiles on profile = {HOME.format('borough')}""")
sql("impute_distances", "properties", f"""
select property_id, cast(trunc({clip(f"-400.0 * ln(1.0 - {uniform('subway')})", 50.0, 5000.0)}) as int) as nearest_subway_m,
  cast(trunc({clip(f"-600.0 * ln(1.0 - {uniform('park')})", 50.0, 4000.0)}) as int) as nearest_park_m,
  cast({uniform('flood')} >= 0.92 as int) as flood_zone_flag from properties""")

# streaming
sql("stream_sales", "canonical", """
select distinct 'LIVE_' || md5(address) || '_' || cast(cast(trunc(price) as bigint) as varchar) as property_id,
  address, price, sqft, cast(year(sale_date) as int) as sale_year, cast(quarter(sale_date) as int) as sale_quarter
from canonical where sale_date is not null and price >= 20000 and sqft >= 10 and price_per_sqft between 50 and 5000""")
sql("stream_market_window", "", f"""
select strftime(w, '%Y-%m-%d %H:%M') as window_start, strftime(w + interval 6 day, '%Y-%m-%d %H:%M') as window_end, event_type,
  count(*) as n, {r('avg(value)')} as mean_value, {r('min(value)')} as lowest, {r('max(value)')} as highest
from events, (select unnest(generate_series(timestamp '1970-01-01' + interval 2 day * cast(floor(epoch((select min(ts) from events)) / 172800 - 3) as int),
  (select max(ts) from events), interval 2 day)) as w)
where ts >= w and ts < w + interval 6 day and w + interval 6 day <= (select max(ts) from events) - interval 1 day
group by w, event_type""")
sql("stream_enrich", "", """
select event_id, user_id, value, c_mktsegment from events left join customer on c_custkey = user_id""")

# model inputs and classifiers
sql("impute_numeric", "canonical", "select address, " + ", ".join(
    f"coalesce({c}, {r(f'median({c}) over ()', 9)}) as {c}" for c in ("lot_sqft", "sqft", "year_built")) + " from canonical")
sql("scale_numeric", "properties", "select property_id, " + ", ".join(
    f"{r(f'({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0)')} as {c}"
    for c in ("sqft", "walk_score", "crime_rate_per_1k", "lat")) + " from properties")
MOST = "(select {0} from {1} where {0} is not null group by 1 order by count(*) desc, {0} limit 1)"
CTE["gaps"] = (("properties",), """
select property_id, borough, case when item_key % 7 <> 0 then building_class end as building_class from properties""")
sql("impute_categorical", "gaps", "select property_id, " + ", ".join(
    f"coalesce({c}, {MOST.format(c, 'gaps')}) as {c}" for c in ("borough", "building_class")) + " from gaps")
CODE = "(select {0} as v, cast(row_number() over (order by {0}) - 1 as int) as code from (select distinct {0} from properties where borough <> 'EUROPE'))"
sql("encode_ordinal", "properties", f"""
select property_id, coalesce(b.code, -1) as borough, coalesce(c.code, -1) as building_class from properties
left join {CODE.format('borough')} b on b.v = borough left join {CODE.format('building_class')} c on c.v = building_class""")
ORDER = "('0x' || substr(md5(cast({0} as varchar)), 1, 13))::bigint"


def split(table: str, key: str, label: str) -> str:
    return f"""
select t.*, {ORDER.format(key)} <= cutoff as is_test from {table} t join (
  select {label} as cut_label, max(o) as cutoff from (select {label}, {ORDER.format(key)} as o,
      row_number() over (partition by {label} order by {ORDER.format(key)}) as place, count(*) over (partition by {label}) as n from {table})
  where place <= ceil(n * 0.2) group by 1) on cut_label = {label}"""


sql("stratified_split", "features",
    f"select property_id, valuation_label, is_test from ({split('features', 'property_id', 'valuation_label')})")
CTE["halves"] = ((), split("embeddings", "vec_id", "label"))


def nearest(k: int, distance: str) -> str:
    return f"""
select a.vec_id as test_id, b.vec_id as train_id, b.label, {r(distance, 9)} as distance, cast(row_number() over (
    partition by a.vec_id order by {r(distance, 9)}, b.vec_id) as int) as rank
from halves a, halves b where a.is_test and not b.is_test qualify rank <= {k}"""


L2 = "list_distance(cast(a.embedding as double[]), cast(b.embedding as double[]))"
L1 = "list_sum([abs(cast(a.embedding as double[])[i] - cast(b.embedding as double[])[i]) for i in range(1, 65)])"
VOTE = """
select test_id, arg_min(label, (-score, label)) as prediction, {1} as share from (
  select test_id, label, {2} as score from ({0}) group by 1, 2) group by 1"""
sql("knn_join", "halves", f"select test_id, train_id, label, {r('distance')} as distance, rank from ({nearest(5, L2)})")
sql("classify_knn", "halves", VOTE.format(nearest(5, L2), r("max(score) / sum(score)"), r("sum(1.0 / distance)", 9)))
sql("classify_knn_manhattan", "halves", VOTE.format(nearest(7, L1), r("max(score) / sum(score)"), "count(*)"))

CTE["ranked"] = (("features",), f"""
select *, {pct_rank('crime_rate_per_1k')} as crime_neighborhood_percentile,
  {pct_rank('school_quality_score')} as school_neighborhood_percentile from features""")
EVERY = "(select {0} as v, cast(row_number() over (order by {0}) - 1 as double) as code from (select distinct {0} from features))"
sql("build_preprocessor", "ranked", "select property_id, " + ", ".join(
    f"{r(f'({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0)')} as {c}" for c in V.MODEL_NUMERIC) + f""",
  b.code as borough, c.code as building_class from ranked
join {EVERY.format('borough')} b on b.v = borough join {EVERY.format('building_class')} c on c.v = building_class""")
CTE["prepared"] = (("ranked",), "select property_id, valuation_label, [" + ", ".join(
    f"coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 0)" for c in V.MODEL_NUMERIC) + f""",
  b.code, c.code]::double[] as vec from ranked
join {EVERY.format('borough')} b on b.v = borough join {EVERY.format('building_class')} c on c.v = building_class""")
STORED = f"""
select a.property_id as test_id, b.property_id as train_id, b.valuation_label as label, {r('list_distance(a.vec, b.vec)', 9)} as distance,
  cast(row_number() over (partition by a.property_id order by {r('list_distance(a.vec, b.vec)', 9)}, b.property_id) as int) as rank
from prepared a join prepared b on {ORDER.format('a.property_id')} % 50 = 0 qualify rank <= 5"""
# the same of every property; the five nearest are kept while the pairs pass, not sorted afterwards
STORED_ALL = f"""
select test_id, near.label as label, near.distance as distance from (
  select a.property_id as test_id, unnest(min({{'distance': {r('list_distance(a.vec, b.vec)', 9)}, 'train_id': b.property_id,
    'label': b.valuation_label}}, 5)) as near from prepared a cross join prepared b group by a.property_id)"""
sql("knn_model_stored", "prepared", f"select test_id, train_id, label, {r('distance')} as distance, rank from ({STORED})")
sql("classify_knn_stored", "prepared", """
select test_id, arg_min(label, (-score, label)) as prediction, {0} as share from (
  select test_id, label, {1} as score from (
    select *, bool_or(distance = 0) over (partition by test_id) as exact from ({2})) group by 1, 2) group by 1""".format(
    r("max(score) / sum(score)"), r("case when bool_or(exact) then count_if(distance = 0) else sum(1.0 / distance) end", 9),
    STORED_ALL))
for t in (1, 2, 3):
    CTE[f"cut{t}"] = (("judged",), f"""
select actual, case when p < 0.{t} then 0 when p > 1 - 0.{t} then 2 else 1 end as predicted, count(*) as n from judged group by 1, 2""")
    CTE[f"cut_classes{t}"] = ((f"cut{t}",), per_class(f"cut{t}"))
COMPARED = " union all ".join(f"select 'cut_0.{t}' as model, * from ({METRICS} cut_classes{t})" for t in (1, 2, 3))
CUTS = "cut_classes1 cut_classes2 cut_classes3"
sql("model_comparison", CUTS, "select model, " + ", ".join(
    f"{r(m, 4)} as {m}" for m in ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro", "cohen_kappa"))
    + f" from ({COMPARED})")
sql("rank_models", CUTS, f"""
select model, f1_macro, cast(row_number() over (order by f1_macro desc, model) as int) as place from ({COMPARED})""")
sql("best_model", CUTS, f"""
select model, f1_macro, row_number() over (order by f1_macro desc, model) = 1 as best from ({COMPARED})""")
sql("save_model", "features", " union all ".join(
    f"select '{c}' as feature, {r(r(f'median({c})', 9))} as median, {r(f'avg({c})')} as mean, {r(f'stddev_pop({c})')} as std from features"
    for c in V.CONTENT_FEATURES))
sql("load_model", "vectors", f"select property_id, {r('list_sum(v)')} as total from vectors")
