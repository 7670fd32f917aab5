"""The SQL each query is compared with, for a second engine over the same tables.

Written independently of the DataFrame code: plain SQL over whole tables, doubles to six decimals.
"""

from __future__ import annotations

FEED = """
raw as (
  select concat('S', user_id) as StationID, event_id,
    case when event_id % 101 = 0 then 'not-a-date' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as DATE,
    value as TMP,
    case when event_id % 29 = 0 then null
         else value - cast((event_id * 37) % 1000 as double) / 100 end as DEW,
    cast((event_id * 53) % 360 as double) as WND_ANGLE,
    cast((event_id * 11) % 300 as double) / 10 as WND_RATE,
    case when event_id % 13 = 0 then null
         else 980 + cast((event_id * 7) % 600 as double) / 10 end as SLP,
    case when event_id % 17 = 0 then '[1 1 0 1 1]' else '[1 1 1 1 1]' end as MASK
  from events),
stations as (
  select concat('S', c_custkey) as StationID,
    cast((c_custkey * 37) % 181 - 90 as double) as latitude,
    cast((c_custkey * 73) % 361 - 180 as double) as longitude,
    c_acctbal as ELEVATION,
    0.5 + cast((c_custkey * 7) % 51 as double) / 100 as valid_percent
  from customer),
clean as (
  select StationID, event_id, DATE as datetime, TMP as Temperature, DEW as DewPoint,
    WND_ANGLE as WindDirection, WND_RATE as WindSpeed, SLP as Pressure
  from raw semi join (select * from stations where valid_percent >= 0.8) v using (StationID)
  where MASK = '[1 1 1 1 1]'),
labelled as (
  select *, Temperature - DewPoint as DewPointDepression,
    case when Temperature - DewPoint < 2.5 then cast(1 as double) else cast(0 as double) end as Rain
  from (select *, try_cast(datetime as timestamp) as datetime_ts from clean) p
  where datetime_ts is not null),
led as (
  select *, lead(Rain) over w as Rain_next, lead(Temperature) over w as Temp_next
  from labelled window w as (partition by StationID order by datetime_ts, event_id)),
targets as (
  select *, Rain_next as label_clf from led where Rain_next is not null and Temp_next is not null),
medians as (
  select median(Temperature) as t, median(DewPoint) as d, median(Pressure) as p,
    median(WindSpeed) as s, median(WindDirection) as a from targets),
filled as (
  select StationID, event_id, datetime, coalesce(Temperature, t) as Temperature,
    coalesce(DewPoint, d) as DewPoint, coalesce(WindDirection, a) as WindDirection,
    coalesce(WindSpeed, s) as WindSpeed, coalesce(Pressure, p) as Pressure,
    datetime_ts, DewPointDepression, Rain, Rain_next, Temp_next, label_clf
  from targets, medians),
calendar as (
  select *, hour(datetime_ts) as "Hour", month(datetime_ts) as "Month",
    dayofweek(datetime_ts) + 1 as DayOfWeek, dayofyear(datetime_ts) as DayOfYear,
    sin(2 * cast(3.14159 as double) * hour(datetime_ts) / 24) as Hour_sin,
    cos(2 * cast(3.14159 as double) * hour(datetime_ts) / 24) as Hour_cos,
    sin(2 * cast(3.14159 as double) * month(datetime_ts) / 12) as Month_sin,
    cos(2 * cast(3.14159 as double) * month(datetime_ts) / 12) as Month_cos
  from filled),
history as (
  select *,
    lag(Temperature, 1) over w as Temp_lag1, lag(Temperature, 3) over w as Temp_lag3,
    lag(Temperature, 6) over w as Temp_lag6, lag(Temperature, 24) over w as Temp_lag24,
    lag(DewPoint, 1) over w as DewPoint_lag1, lag(Pressure, 1) over w as Pressure_lag1,
    lag(WindSpeed, 1) over w as WindSpeed_lag1,
    lag(Rain, 1) over w as Rain_lag1, lag(Rain, 3) over w as Rain_lag3,
    avg(Temperature) over w6 as Temp_roll6h, avg(Temperature) over w24 as Temp_roll24h,
    avg(DewPoint) over w6 as DewPoint_roll6h, avg(Pressure) over w6 as Pressure_roll6h,
    sum(Rain) over w6 as Rain_sum6h, sum(Rain) over w24 as Rain_sum24h
  from calendar
  window w as (partition by StationID order by datetime_ts, event_id),
    w6 as (partition by StationID order by datetime_ts, event_id rows between 6 preceding and 1 preceding),
    w24 as (partition by StationID order by datetime_ts, event_id rows between 24 preceding and 1 preceding)),
changed as (
  select *, Temperature - Temp_lag1 as TempChange_1h, DewPoint - DewPoint_lag1 as DewPointChange_1h,
    Pressure - Pressure_lag1 as PressureChange_1h, Temperature - DewPoint as TempDewPoint
  from history),
features as (
  select *, case when
      cast('0x' || substr(md5(StationID || '|' || event_id), 1, 8) as bigint) < 0.2 * 4294967296
      then 'test' else 'train' end as split
  from changed
  where Temp_lag24 is not null and DewPointDepression is not null and Rain_lag3 is not null
    and Temp_roll24h is not null and DewPoint_roll6h is not null and Pressure_roll6h is not null
    and Pressure is not null and WindSpeed_lag1 is not null)
"""

J1_COLUMNS = """
StationID event_id datetime Temperature DewPoint WindDirection WindSpeed Pressure datetime_ts
DewPointDepression Rain Rain_next Temp_next label_clf
""".split()
NUMERIC = """
Temperature DewPoint Pressure WindSpeed WindDirection DewPointDepression Rain
Hour Month DayOfWeek DayOfYear Hour_sin Hour_cos Month_sin Month_cos
Temp_lag1 Temp_lag3 Temp_lag6 Temp_lag24 DewPoint_lag1 Pressure_lag1 WindSpeed_lag1 Rain_lag1 Rain_lag3
Temp_roll6h Temp_roll24h DewPoint_roll6h Pressure_roll6h Rain_sum6h Rain_sum24h
TempChange_1h DewPointChange_1h PressureChange_1h TempDewPoint
""".split()
WHOLE = {"Hour", "Month", "DayOfWeek", "DayOfYear", "event_id"}
TEXT = {"StationID", "datetime", "DATE", "MASK", "split"}
MEASURES = ("Temperature", "DewPoint", "Pressure", "WindSpeed", "WindDirection")
REGIONS = """
('global', -90, 90, -180, 180), ('asia', -10, 75, 25, 180), ('europe', 35, 72, -25, 50),
('north_america', 10, 85, -170, -50), ('south_america', -60, 15, -90, -30),
('africa', -35, 38, -20, 55), ('oceania', -50, 5, 100, 180)
"""
CLASS_BASELINES = {
    "PERSISTENCE": ("Rain", "-DewPointDepression"),
    "LAG3": ("Rain_lag3", "Rain_sum6h"),
    "OFTEN": ("case when Rain_sum24h >= 6 then cast(1 as double) else cast(0 as double) end", "Rain_sum24h"),
}
VALUE_BASELINES = {"PERSISTENCE": "Temperature", "ROLL6": "Temp_roll6h", "ROLL24": "Temp_roll24h"}


def r6(expression: str) -> str:
    """Six decimals, never a negative zero."""
    return f"round({expression}, 6) + cast(0 as double)"


def shown(name: str) -> str:
    if name in WHOLE:
        return f'cast("{name}" as bigint) as "{name}"'
    if name in TEXT:
        return name
    if name == "datetime_ts":
        return "strftime(datetime_ts, '%Y-%m-%d %H:%M:%S') as datetime_ts"
    return f"{r6(name)} as {name}"


def over(source: str, *names: str) -> str:
    return f"with {FEED} select {', '.join(shown(n) for n in names)} from {source}"


def keyed(source: str, *names: str) -> str:
    return over(source, "StationID", "event_id", *names)


def feed(select: str) -> str:
    return f"with {FEED} {select}"


def _class_predictions(name: str) -> str:
    said, score = CLASS_BASELINES[name]
    return f"select label_clf as y, {said} as p, {score} as s from features"


def _auc(name: str) -> str:
    """Rank formula with mid-ranks for ties."""
    return f"""
    (select (sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))
     from (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / cast(2 as double) as rk
           from ({_class_predictions(name)}) a) b)"""


def _class_metric(name: str, metric: str) -> str:
    """Class-weighted metrics by joining per-class totals."""
    formula = {
        "accuracy": "sum(hit) / sum(actual)",
        "recall": "sum(actual * (hit / actual)) / sum(actual)",
        "precision": "sum(actual * case when said > 0 then hit / said else 0 end) / sum(actual)",
        "f1": "sum(actual * case when hit > 0 then 2 * (hit / said) * (hit / actual)"
        " / (hit / said + hit / actual) else 0 end) / sum(actual)",
    }[metric]
    return f"""
    (with pr as ({_class_predictions(name)}),
      c as (select y as k, cast(count(*) as double) as actual,
              cast(count(*) filter (where p = y) as double) as hit from pr group by y),
      q as (select p as k, cast(count(*) as double) as said from pr group by p)
     select {formula} from (select c.k, actual, hit, coalesce(said, 0) as said from c left join q on c.k = q.k) t)"""


def _value_metric(name: str, metric: str) -> str:
    p = VALUE_BASELINES[name]
    formula = {
        "RMSE": f"sqrt(avg((Temp_next - {p}) * (Temp_next - {p})))",
        "MAE": f"avg(abs(Temp_next - {p}))",
        "R2": f"1 - sum((Temp_next - {p}) * (Temp_next - {p}))"
        " / sum((Temp_next - m) * (Temp_next - m))",
    }[metric]
    return f"(select {formula} from features, (select avg(Temp_next) as m from features) mean)"


def _metric_rows() -> str:
    parts = []
    for name in CLASS_BASELINES:
        for label, metric in (("Accuracy", "accuracy"), ("Precision", "precision"), ("Recall", "recall"), ("F1-Score", "f1")):
            parts.append(
                f"select 'classification' as task, '{name}' as model, '{label}' as metric,"
                f" {_class_metric(name, metric)} as value"
            )
        parts.append(
            f"select 'classification' as task, '{name}' as model, 'AUC-ROC' as metric, {_auc(name)} as value"
        )
    for name in VALUE_BASELINES:
        for metric in ("RMSE", "MAE", "R2"):
            parts.append(
                f"select 'regression' as task, '{name}' as model, '{metric}' as metric,"
                f" {_value_metric(name, metric)} as value"
            )
    return " union all ".join(parts)


def metrics(select: str) -> str:
    return f"with {FEED}, m as ({_metric_rows()}) {select}"


def _histogram(bins: int, measures: tuple[str, ...], keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    tall = " union all ".join(
        f"select {lead}'{m}' as measure, {e} as value from clean where {e} is not null"
        for m, e in ((m, "Temperature - DewPoint" if m == "DPD" else m) for m in measures)
    )
    by = f"{lead}measure"
    return feed(f""", tall as ({tall}),
      bounds as (select {by}, min(value) as low, max(value) as high from tall group by {by})
      select {by}, bin, cast(count(*) as bigint) as rows from (
        select {by}, cast(case when high = low then {bins // 2}
          else least(floor((value - low) / (high - low) * {bins}), {bins - 1}) end as bigint) as bin
        from tall join bounds using ({by})) b
      group by {by}, bin""").replace(") ,", "),", 1)


def _widths() -> str:
    return f"{len(NUMERIC)} + (select count(distinct StationID) from features) + 1"


def _vector_sums() -> str:
    numeric = " union all ".join(
        f"""select cast({at} as bigint) as "at", coalesce(sum("{n}") / nullif(stddev_samp("{n}"), 0), 0) as total from features"""
        for at, n in enumerate(NUMERIC)
    )
    return feed(f"""select "at", round(total, 3) + cast(0 as double) as total from ({numeric}
        union all select {len(NUMERIC)} + idx, coalesce(k / nullif(sqrt(k * (n - k) / (n * (n - 1))), 0), 0)
          from ({RANKED}) r join (select StationID, cast(count(*) as double) as k from features group by StationID) c
            using (StationID), (select cast(count(*) as double) as n from features) a
        union all select {len(NUMERIC)} + (select count(distinct StationID) from features), 0) s""")


def _scaled() -> str:
    stats = ", ".join(f'stddev_samp("{n}") as "s_{n}"' for n in NUMERIC)
    shown_columns = ", ".join(
        f'''{r6(f'case when "s_{n}" = 0 then 0 else "{n}" / "s_{n}" end')} as "{n}"''' for n in NUMERIC
    )
    return feed(
        f"select StationID, event_id, cast({_widths()} as bigint) as width, {shown_columns}"
        f" from features, (select {stats} from features) s"
    )


RANKED = """select StationID, row_number() over (order by count(*) desc, StationID) - 1 as idx
  from features group by StationID"""

_STAGED = feed("""select cast(50 as bigint) as stages, cast(0 as bigint) as rises, count(*) as rows, count(*) as agreeing
    from features where split = 'train'""")
ORACLES: dict[str, str] = {
    "a01_read_observations": feed(f"""select r.StationID, DATE, {r6("s.longitude")} as LONGITUDE,
        {r6("s.latitude")} as LATITUDE, {r6("TMP")} as TMP, {r6("DEW")} as DEW, {r6("WND_ANGLE")} as WND_ANGLE,
        {r6("WND_RATE")} as WND_RATE, {r6("SLP")} as SLP, MASK, cast(null as double) as TIME_DIFF
        from raw r left join stations s on r.StationID = s.StationID"""),
    "a01_mixed_headers": feed(f"""select r.StationID, DATE, {r6("s.longitude")} as LONGITUDE,
        {r6("s.latitude")} as LATITUDE, {r6("TMP")} as TMP, {r6("DEW")} as DEW, {r6("WND_ANGLE")} as WND_ANGLE,
        case when kind < 2 then {r6("WND_RATE")} end as WND_RATE, case when kind < 2 then {r6("SLP")} end as SLP,
        MASK, cast(null as double) as TIME_DIFF
        from (select *, cast(substr(StationID, 2) as bigint) % 3 as kind from raw) r
        left join stations s on r.StationID = s.StationID"""),
    "a02_entity_from_file": feed("select StationID, count(*) as rows from raw group by StationID"),
    "a03_read_stations": feed(f"""select StationID, StationID || '.csv' as file_name,
        {r6("latitude")} as latitude, {r6("longitude")} as longitude, {r6("ELEVATION")} as ELEVATION,
        {r6("valid_percent")} as valid_percent from stations"""),
    "a04_missing_files": feed("""select StationID from stations where valid_percent >= 0.8
        and StationID not in (select StationID from raw)"""),
    "a05_station_rows": feed(f"""select {', '.join(shown(n) for n in J1_COLUMNS[:8])} from clean
        where StationID = (select StationID from clean group by StationID order by count(*) desc, StationID limit 1)"""),
    "a06_save_table": over("clean", *J1_COLUMNS[:8]),
    "a07_load_split": feed(f"""select StationID, event_id, case when
        cast('0x' || substr(md5(StationID || '|' || event_id), 1, 8) as bigint) < 0.2 * 4294967296
        then 'test' else 'train' end as split, {r6("Temperature")} as Temperature from clean"""),
    "a08_model_store": feed("select count(*) as rows, cast(0 as bigint) as changed from features where split = 'test'"),
    "a09_metrics_document": metrics(f"""select cast(3 as bigint) as classifiers, cast(3 as bigint) as regressors,
        {r6(_class_metric("PERSISTENCE", "accuracy"))} as persistence_accuracy,
        {r6(_value_metric("PERSISTENCE", "RMSE"))} as persistence_rmse,
        (select count(*) from features where split = 'train') as train_count,
        (select count(*) from features where split = 'test') as test_count"""),
    "a10_load_metrics": metrics(f"select task, model, metric, {r6('value')} as value from m"),
    "a11_summary": feed(" union all ".join(
        f"select count(*) as rows, cast({i} as bigint) as position, '{n}' as name, "
        f"'{'bigint' if n == 'event_id' else 'string' if n in TEXT else 'double'}' as type, "
        f"count({n}) as non_null from clean"
        for i, n in enumerate(J1_COLUMNS[:8])
    )),
    "b01_mask_filter": feed(f"""select {', '.join(shown(n) for n in
        ('StationID', 'event_id', 'DATE', 'TMP', 'DEW', 'WND_ANGLE', 'WND_RATE', 'SLP', 'MASK'))}
        from raw where MASK = '[1 1 1 1 1]'"""),
    "b02_canonical_names": feed(f"""select StationID, event_id, DATE as datetime, {r6("TMP")} as Temperature,
        {r6("DEW")} as DewPoint, {r6("WND_ANGLE")} as WindDirection, {r6("WND_RATE")} as WindSpeed,
        {r6("SLP")} as Pressure from raw"""),
    "b03_column_drop": over("clean", *J1_COLUMNS[:8]),
    "b04_parse_time": keyed("labelled", "datetime", "datetime_ts"),
    "b05_depression": keyed("labelled", "DewPointDepression"),
    "b06_rain_label": keyed("labelled", "DewPointDepression", "Rain"),
    "b07_class_label": keyed("targets", "Rain_next", "label_clf"),
    "b08_value_label": feed(f"""select StationID, event_id, {r6("Temp_next")} as Temp_next,
        {r6("cast(Temp_next as double)")} as label_reg from targets"""),
    "b09_drop_without_target": keyed("targets", "Temperature", "Rain_next", "Temp_next"),
    "b10_complete_rows": keyed("features", "Temp_lag24", "DewPointDepression"),
    "b11_fill_missing": keyed("filled", *MEASURES, "DewPointDepression"),
    "b12_valid_stations": feed(f"""select StationID, {r6("latitude")} as latitude, {r6("longitude")} as longitude,
        {r6("ELEVATION")} as ELEVATION, {r6("valid_percent")} as valid_percent
        from stations where coalesce(valid_percent, 0) >= 0.8"""),
    "b13_regions": feed(f"""select region, StationID from stations
        join (values {REGIONS}) r(region, south, north, west, east)
          on latitude between south and north and longitude between west and east
        where not (latitude = 0 and longitude = 0)"""),
    "b13_region_table": feed("""select box, StationID from (
          select c_custkey as box, cast((c_custkey * 37) % 181 - 90 as double) as south,
            cast((c_custkey * 73) % 361 - 180 as double) as west, (c_custkey % 7) * (c_custkey % 5) as high,
            (c_custkey % 11) * (c_custkey % 9) * (c_custkey % 3) as wide from customer) b
        join stations on latitude between south and south + high and longitude between west and west + wide
        where not (latitude = 0 and longitude = 0)"""),
    "b14_located": feed(f"""select StationID, {r6("latitude")} as latitude, {r6("longitude")} as longitude
        from stations where not (latitude = 0 and longitude = 0)"""),
    "b15_map_points": feed(f"""select StationID as Station, {r6("latitude")} as latitude,
        {r6("longitude")} as longitude, {r6("coalesce(ELEVATION, 0)")} as elevation,
        round(valid_percent * 100, 1) as valid_percent
        from stations where not (latitude = 0 and longitude = 0)"""),
    "b16_series": feed(" union all ".join(
        f"select StationID, event_id, datetime, '{m}' as measure, {r6(m)} as value from clean where {m} is not null"
        for m in MEASURES
    )),
    "b17_feature_columns": keyed("features", *NUMERIC),
    "c01_hour": keyed("calendar_of_labelled", "Hour"),
    "c02_month": keyed("calendar_of_labelled", "Month"),
    "c03_day_of_week": keyed("calendar_of_labelled", "DayOfWeek"),
    "c04_day_of_year": keyed("calendar_of_labelled", "DayOfYear"),
    "c05_hour_on_circle": keyed("calendar_of_labelled", "Hour_sin", "Hour_cos"),
    "c06_month_on_circle": keyed("calendar_of_labelled", "Month_sin", "Month_cos"),
    "c07_difference": feed(f"select StationID, event_id, {r6('TMP - DEW')} as gap from raw"),
    "c08_conditional": feed("""select StationID, event_id,
        case when TMP - DEW < 2.5 then cast(1 as double) else cast(0 as double) end as flag from raw"""),
    "c09_cast": feed("""select StationID, event_id, cast(event_id as double) as event_value,
        'feed' as origin from raw"""),
    "c10_try_parse": feed("""select StationID, event_id, DATE,
        strftime(try_cast(DATE as timestamp), '%Y-%m-%d %H:%M:%S') as at from raw"""),
    "c11_strip_suffix": feed("select StationID || '.csv' as file_name, StationID from stations"),
    "c12_null_tests": feed("""select StationID, event_id, DEW is null as no_dew, SLP is not null as has_slp,
        DEW is not null and SLP is not null as both from raw"""),
    "c13_round": feed("select StationID, round(valid_percent * 100, 1) as valid from stations"),
    "d01_targets": keyed("led", "Rain_next", "Temp_next"),
    "d02_temperature_lags": keyed("history", "Temp_lag1", "Temp_lag3", "Temp_lag6", "Temp_lag24"),
    "d03_measure_lags": keyed("history", "DewPoint_lag1", "Pressure_lag1", "WindSpeed_lag1"),
    "d04_label_lags": keyed("history", "Rain_lag1", "Rain_lag3"),
    "d05_rolling_means": keyed("history", "Temp_roll6h", "Temp_roll24h", "DewPoint_roll6h", "Pressure_roll6h"),
    "d06_rolling_sums": keyed("history", "Rain_sum6h", "Rain_sum24h"),
    "d07_changes": keyed("changed", "TempChange_1h", "DewPointChange_1h", "PressureChange_1h"),
    "d08_depression_copy": keyed("changed", "TempDewPoint", "DewPointDepression"),
    "e01_audits": feed("""select 'mask' as stage, count(*) as before,
          count(*) filter (where MASK = '[1 1 1 1 1]') as after,
          count(*) filter (where MASK <> '[1 1 1 1 1]') as removed from raw
        union all select 'targets', (select count(*) from led), (select count(*) from targets),
          (select count(*) from led) - (select count(*) from targets)
        union all select 'features', (select count(*) from changed), (select count(*) from features),
          (select count(*) from changed) - (select count(*) from features)"""),
    "e02_positive_ratio": feed(f"""select cast(sum(Rain) as bigint) as positive, count(*) as rows,
        {r6("sum(Rain) * 100 / count(*)")} as percent from labelled"""),
    "e03_medians": feed(" union all ".join(
        f"select '{m}' as measure, {r6(f'median({m})')} as median from targets" for m in MEASURES
    )),
    "e04_missing_profile": feed("select * from (" + " union all ".join(
        f"select '{m}' as \"column\", count(*) - count({m}) as missing,"
        f" {r6(f'(count(*) - count({m})) * cast(100 as double) / count(*)')} as percent from clean"
        for m in MEASURES
    ) + ") x where missing > 0"),
    "e05_entities": feed("select count(distinct StationID) as entities from clean"),
    "e06_label_distribution": feed("select label_clf, count(*) as rows from targets group by label_clf"),
    "e07_histogram": _histogram(60, ("Temperature", "DewPoint", "DPD")),
    "e07_station_histogram": _histogram(80, ("Temperature", "DPD"), "StationID"),
    "e08_station_profile": feed(f"""select StationID, count(*) as rows,
        {r6("avg(Temperature)")} as mean_temperature,
        {r6("count(*) filter (where Temperature - DewPoint < 2.5) * cast(100 as double)"
            " / nullif(count(Temperature - DewPoint), 0)")} as rain_percent
        from clean group by StationID"""),
    "e09_coverage": feed(f"""select region, count(s.StationID) as stations,
        (select count(*) from stations) as total
        from (values {REGIONS}) r(region, south, north, west, east)
        left join (select * from stations where not (latitude = 0 and longitude = 0)) s
          on latitude between south and north and longitude between west and east
        group by region"""),
    "e10_split_sizes": feed(f"""select split, count(*) as rows,
        {r6("count(*) * cast(100 as double) / (select count(*) from features)")} as percent
        from features group by split"""),
    "e11_confusion_counts": feed("""select label_clf as label, Rain as prediction, count(*) as rows
        from features group by label_clf, Rain"""),
    "e12_confusion_matrix": feed("""select
        count(*) filter (where label_clf = 1 and Rain = 1) as TP, count(*) filter (where label_clf = 0 and Rain = 1) as FP,
        count(*) filter (where label_clf = 1 and Rain = 0) as FN, count(*) filter (where label_clf = 0 and Rain = 0) as TN
        from features"""),
    "f01_ordered": feed("""select label_clf as label, Rain_lag3 as prediction, count(*) as rows
        from features group by label_clf, Rain_lag3 order by 1, 2"""),
    "f02_head": over("clean", *J1_COLUMNS[:8]) + " order by StationID, event_id limit 5",
    "f03_capped_sample": keyed("clean", "DewPoint")
        + " where DewPoint is not null order by md5(StationID || '|' || event_id) limit 1000",
    "f04_sampled_stations": feed("""select StationID from stations where valid_percent >= 0.8
        order by md5(StationID || '|42'), StationID limit 50"""),
    "f05_station_list": feed("select StationID from stations order by StationID limit 200"),
    "f06_best_models": metrics(f"""select task, metric, model, {r6("value")} as value from m
        where (task, metric) in (('classification', 'AUC-ROC'), ('regression', 'RMSE'))
        qualify row_number() over (partition by task
          order by case when metric = 'RMSE' then value else -value end, model) = 1"""),
    "f07_best_per_metric": metrics(f"""select task, metric, model, {r6("value")} as value from m
        qualify row_number() over (partition by task, metric
          order by case when metric in ('RMSE', 'MAE') then value else -value end, model) = 1"""),
    "g01_union_by_name": keyed("raw", "TMP", "DEW"),
    "g02_of_stations": keyed("raw semi join (select * from stations where valid_percent >= 0.8) v using (StationID)", "TMP"),
    "g03_station_info": feed(f"""select r.StationID, event_id, {r6("latitude")} as latitude,
        {r6("longitude")} as longitude, {r6("ELEVATION")} as ELEVATION,
        {r6("coalesce(valid_percent, 0)")} as valid_percent
        from raw r left join stations s on r.StationID = s.StationID"""),
    "h01_string_index": feed(RANKED),
    "h02_one_hot": feed(f"""select StationID, (select count(distinct StationID) from features) + 1 as width,
        idx as active from ({RANKED}) x"""),
    "h03_assembled": feed(f"""select StationID, event_id, cast({_widths()} as bigint) as width,
        {', '.join(f'{r6(f"""cast("{n}" as double)""")} as "{n}"' for n in NUMERIC)} from features"""),
    "h04_scaled": _scaled(),
    "h05_base_stages": feed(f"select count(*) as rows, cast({_widths()} as bigint) as width from features"),
    "h06_hash_split": feed("""select StationID, event_id, case when
        cast('0x' || substr(md5(StationID || '|' || event_id), 1, 8) as bigint) < 0.2 * 4294967296
        then 'test' else 'train' end as split from clean"""),
    "h07_split_placement": feed("""select split, cast(case when split = 'train' then 32 else 8 end as bigint) as partitions,
        count(*) as rows from features group by split"""),
    "h11_single_feature_line": feed(f"""select {r6("regr_slope(Temp_next, Temp_roll24h)")} as slope,
        {r6("regr_intercept(Temp_next, Temp_roll24h)")} as intercept from features"""),
    "h15_batch_scoring": feed("select count(*) as rows, count(*) as scored from features where split = 'test'"),
    "i01_auc": feed(" union all ".join(
        f"select '{n}' as model, {r6(_auc(n))} as auc" for n in CLASS_BASELINES
    )),
    "i02_accuracy": feed(f"select {r6(_class_metric('PERSISTENCE', 'accuracy'))} as accuracy"),
    "i03_weighted_f1": feed(f"select {r6(_class_metric('PERSISTENCE', 'f1'))} as f1"),
    "i04_weighted_precision": feed(f"select {r6(_class_metric('PERSISTENCE', 'precision'))} as precision"),
    "i05_weighted_recall": feed(f"select {r6(_class_metric('PERSISTENCE', 'recall'))} as recall"),
    "i06_rmse": feed(f"select 'RMSE' as metric, {r6(_value_metric('PERSISTENCE', 'RMSE'))} as value"),
    "i07_mae": feed(f"select 'MAE' as metric, {r6(_value_metric('PERSISTENCE', 'MAE'))} as value"),
    "i08_r2": feed(f"select 'R2' as metric, {r6(_value_metric('PERSISTENCE', 'R2'))} as value"),
    "i09_evaluate": metrics(f"select task, model, metric, {r6('value')} as value from m"),
    "i10_compare_classifiers": metrics("select *, \"AUC-ROC\" = max(\"AUC-ROC\") over () as best from (select model, "
        + ", ".join(
            f"{r6(f'''max(value) filter (where metric = '{n}')''')} as \"{n}\""
            for n in ("Accuracy", "Precision", "Recall", "F1-Score", "AUC-ROC")
        ) + " from m where task = 'classification' group by model) w"),
    "i10_compare_regressors": metrics("select *, RMSE = min(RMSE) over () as best from (select model, "
        + ", ".join(
            f"{r6(f'''max(value) filter (where metric = '{n}')''')} as {n}" for n in ("RMSE", "MAE", "R2")
        ) + " from m where task = 'regression' group by model) w"),
    "i11_printable": metrics("select task, model, metric, printf('%.4f', value) as value from m"),
    "j01_preprocess": over("filled", *J1_COLUMNS),
    "j02_feature_rows": over("features", *J1_COLUMNS, *[n for n in NUMERIC if n not in J1_COLUMNS]),
    "h06_csv_split": "select count(*) as rows, cast(0 as bigint) as moved from events",
    "h11_normal_equations": feed(f"""select inputs, inputs as orthogonal from (select cast({_widths()}
        - (select count(distinct StationID) from features)
        + (select count(distinct StationID) from features where split = 'train') as bigint) as inputs) x"""),
    "h09_walked": feed("select count(*) as rows, count(*) as agreeing from features where split = 'test'"),
    "h12_walked": feed("select count(*) as rows, count(*) as agreeing from features where split = 'test'"),
    "h10_staged_loss": _STAGED,
    "h13_staged_loss": _STAGED,
    "h08_stationary": feed(f"""select inputs, inputs as flat, cast(1 as bigint) as flat_intercepts from (select cast({_widths()}
        - (select count(distinct StationID) from features)
        + (select count(distinct StationID) from features where split = 'train') as bigint) as inputs) x"""),
    "h15_scores_by_join": feed("""select task, model, rows, rows as agreeing
        from (values ('clf', 'lr'), ('reg', 'linear')) m(task, model),
          (select count(*) as rows from features where split = 'test') r"""),
    "h05_vector_sums": _vector_sums(),
    "i01_auc_by_station": feed(f"""select StationID, cast(sum(y) as bigint) as positives,
          cast(count(*) - sum(y) as bigint) as negatives, case when sum(y) > 0 and sum(y) < count(*) then
          {r6("(sum(case when y = 1 then rk end) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))")} end as auc
        from (select StationID, y, rank() over (partition by StationID order by s)
                + (count(*) over (partition by StationID, s) - 1) / cast(2 as double) as rk
              from (select StationID, label_clf as y, {CLASS_BASELINES["PERSISTENCE"][1]} as s from features) a) b
        group by StationID"""),
    "j03_classification_values": feed("""select 'classification' as task, model, metric, rows, true as same
        from (values ('LR'), ('RF'), ('GBT')) m(model),
          (values ('Accuracy'), ('Precision'), ('Recall'), ('F1-Score'), ('AUC-ROC')) v(metric),
          (select count(*) as rows from features where split = 'test') r"""),
    "j04_regression_values": feed("""select 'regression' as task, model, metric, rows, true as same
        from (values ('LINEAR'), ('RF'), ('GBT')) m(model), (values ('RMSE'), ('MAE'), ('R2')) v(metric),
          (select count(*) as rows from features where split = 'test') r"""),
    "h14_train_or_load": """select * from (values ('clf', 'lr', true, true, cast(5 as bigint)),
        ('reg', 'linear', true, true, cast(5 as bigint))) t(task, model, stored, same, stages)""",
    "h14_model_statements": feed("""select task, model, rows, rows as valid, true as beats_constant
        from (values ('clf', 'lr'), ('clf', 'rf'), ('clf', 'gbt'), ('reg', 'linear'), ('reg', 'rf'), ('reg', 'gbt'))
          m(task, model), (select count(*) as rows from features where split = 'test') r"""),
    "j03_classification_grid": """select 'classification' as task, model, metric, true as possible
        from (values ('LR'), ('RF'), ('GBT')) m(model),
          (values ('Accuracy'), ('Precision'), ('Recall'), ('F1-Score'), ('AUC-ROC'), ('rows')) v(metric)""",
    "j04_regression_grid": """select 'regression' as task, model, metric, true as possible
        from (values ('LINEAR'), ('RF'), ('GBT')) m(model), (values ('RMSE'), ('MAE'), ('R2')) v(metric)""",
    "j05_run_audits": feed("""select 'mask' as stage, before, after, before - after as removed from (select
          (select count(*) from raw semi join (select * from stations where valid_percent >= 0.8) v using (StationID))
            as before, (select count(*) from clean) as after) x
        union all select 'targets', (select count(*) from labelled), (select count(*) from targets),
          (select count(*) from labelled) - (select count(*) from targets)
        union all select 'features', (select count(*) from changed), (select count(*) from features),
          (select count(*) from changed) - (select count(*) from features)"""),
    "j05_run_values": feed("""select count(*) as rows, round(sum(Temperature), 3) as Temperature,
        round(sum(Temp_lag24), 3) as Temp_lag24, round(sum(Rain_sum24h), 3) as Rain_sum24h,
        round(sum(Temp_roll6h), 3) as Temp_roll6h, round(sum(PressureChange_1h), 3) as PressureChange_1h,
        round(sum(Temp_next), 3) as Temp_next from features"""),
    "j05_whole_run": feed("""select cast(3 as bigint) as classifiers, cast(3 as bigint) as regressors,
        count(*) as rows from features"""),
}

ORACLES["j02_feature_rows_in_blocks"] = ORACLES["j02_feature_rows"]
ORACLES["d05_rolling_means_bucketed"] = ORACLES["d05_rolling_means"]
ORACLES["h01_string_index_distributed"] = ORACLES["h01_string_index"]

# The scalar functions are checked on every parsed row, before targets and imputation.
for _name in [n for n in ORACLES if n.startswith("c0")]:
    ORACLES[_name] = ORACLES[_name].replace(
        "from calendar_of_labelled",
        """from (select *, hour(datetime_ts) as "Hour", month(datetime_ts) as "Month",
        dayofweek(datetime_ts) + 1 as DayOfWeek, dayofyear(datetime_ts) as DayOfYear,
        sin(2 * cast(3.14159 as double) * hour(datetime_ts) / 24) as Hour_sin,
        cos(2 * cast(3.14159 as double) * hour(datetime_ts) / 24) as Hour_cos,
        sin(2 * cast(3.14159 as double) * month(datetime_ts) / 12) as Month_sin,
        cos(2 * cast(3.14159 as double) * month(datetime_ts) / 12) as Month_cos from labelled) c""",
    )
