"""The same results in DuckDB SQL, over the same tables."""

from __future__ import annotations

READINGS = """
readings as (
  select event_id, 'chb' || case when user_id < 10 then '0' else '' end || user_id as patient_id,
         event_type as channel, ts as event_time,
         case when event_id % 2 = 0 then value else -value end as voltage
  from events
)"""

FEATURES = (
    READINGS
    + """,
features as (
  select g.*, window_start + interval 7 day as window_end, cast(window_start as date) as event_date
  from (
    select patient_id, channel,
           time_bucket(interval 7 day, event_time, timestamp '1970-01-01') as window_start,
           avg(voltage) as mean_v, stddev_samp(voltage) as stddev_v,
           min(voltage) as min_v, max(voltage) as max_v,
           count(*) filter (abs(voltage) > 100) as spike_count
    from readings group by all
  ) g
)"""
)

LABELLED = (
    FEATURES
    + """,
labelled as (
  select *, case when spike_count > 1 then 'spike_threshold'
                 when stddev_v > 100 then 'high_variance' end as alert_reason
  from features
),
alerts as (select * from labelled where alert_reason is not null)"""
)

ANNOTATIONS = """,
annotations as (
  select patient_id, 'chb_rec_' || event_id as recording_file, event_time as seizure_start_ms,
         event_time + to_minutes(cast(trunc(abs(voltage)) as bigint)) as seizure_end_ms
  from readings where channel = 'error' and abs(voltage) > 150
)"""

PAIRS = """,
pairs as (
  select a.*, s.recording_file, s.seizure_start_ms, s.seizure_end_ms
  from alerts a join annotations s
    on a.patient_id = s.patient_id
   and a.window_start < s.seizure_end_ms and s.seizure_start_ms < a.window_end
),
in_vain as (
  select a.* from alerts a anti join annotations s
    on a.patient_id = s.patient_id
   and a.window_start < s.seizure_end_ms and s.seizure_start_ms < a.window_end
)"""

MARTS = """,
patient_summary as (
  select f.patient_id as "PATIENT_ID", f.windows as "TOT_WINDOWS_PROCESSED",
         a.fired as "TOT_ALERTS_FIRED",
         round(coalesce(a.fired * 100.0::double / f.windows, 0), 2) || '%' as "ALERT_RATE"
  from (select patient_id, count(*) as windows from features group by 1) f
  left join (select patient_id, count(*) as fired from alerts group by 1) a using (patient_id)
),
alerts_daily as (
  select patient_id as "PATIENT_ID", channel as "CHANNEL", event_date as "ALERT_DATE",
         count(*) filter (alert_reason = 'spike_threshold') as "SPIKE_THRESHOLD_CNT",
         count(*) filter (alert_reason = 'high_variance') as "HIGH_VAR_CNT"
  from alerts group by 1, 2, 3
),
seizure_detection_rate as (
  select p.hit as "DETECTED", t.n as "TOT_SEIZURES",
         round(p.hit * 100.0::double / t.n, 2) || '%' as "DETECTION_RATE",
         coalesce(v.n, 0) as "FP_COUNT"
  from (select patient_id, cast(1 as bigint) as hit from pairs group by 1) p
  cross join (select count(*) as n from (select distinct patient_id, seizure_start_ms from annotations)) t
  left join (select patient_id, count(*) as n from in_vain group by 1) v using (patient_id)
)"""

_ALERT_COLUMNS = """patient_id, channel, window_start, window_end, round(mean_v, 6) as mean_v,
round(stddev_v, 6) as stddev_v, round(min_v, 6) as min_v, round(max_v, 6) as max_v, spike_count, event_date"""


def _select(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body}"


def _report(ctes: str, checks: dict[str, str], one: tuple[str, ...] = ()) -> str:
    """Rows (check, violations, passed) from scalar queries."""
    rows = "\nunion all ".join(
        f"select '{name}' as \"check\", cast(({query}) as bigint) as violations"
        for name, query in checks.items()
    )
    wanted = f"case when \"check\" in ({', '.join(map(repr, one))}) then 1 else 0 end" if one else "0"
    return _select(ctes, f'select *, violations = {wanted} as passed from ({rows})')


def _where(condition: str, table: str = "features") -> str:
    return f"select count(*) from {table} where {condition}"


ROW_CHECKS = {
    "null_check": _where(
        "patient_id is null or channel is null or window_start is null or window_end is null"
        " or mean_v is null or stddev_v is null or min_v is null or max_v is null"
        " or spike_count is null or event_date is null"
    ),
    "channel_check": _where("channel not in ('click', 'purchase', 'signup', 'view')"),
    "v_range_check": _where("abs(min_v) > 300 or abs(mean_v) > 300 or abs(max_v) > 300"),
    "v_order_check": _where("min_v > mean_v or mean_v > max_v"),
    "stddev_check": _where("stddev_v > max_v - min_v"),
    "spike_stddev_check": _where("spike_count < 0 or stddev_v < 0"),
    "spike_count_check": _where(
        "spike_count > date_diff('second', window_start, window_end) / 262144.0"
    ),
    "window_time_check": _where("window_end <= window_start"),
    "event_date_check": _where("event_date <> cast(window_start as date)"),
    "patient_id_format_check": _where("not regexp_full_match(patient_id, 'chb[0-9]{2}')"),
    "distinct_duration_check": "select count(distinct window_end - window_start) from features",
}

GAPS = """,
gaps as (
  select * from (
    select patient_id, channel, window_start,
           lag(window_end) over (partition by patient_id, channel order by window_start) as prev_end
    from features
  ) where window_start <> prev_end
)"""

GROUP_CHECKS = {
    "window_start_count": "select count(*) from (select patient_id, window_start from features"
    " group by all having count(*) <> 5)",
    "duplicate_check": "select count(*) from (select patient_id, channel, window_start from features"
    " group by all having count(*) > 1)",
}

MART_CHECKS = {
    **{
        f"not_null_{table}_{column.lower()}": _where(f'"{column}" is null', table)
        for table, columns in {
            "patient_summary": (
                "PATIENT_ID",
                "TOT_WINDOWS_PROCESSED",
                "TOT_ALERTS_FIRED",
                "ALERT_RATE",
            ),
            "alerts_daily": ("PATIENT_ID", "CHANNEL", "ALERT_DATE"),
            "seizure_detection_rate": ("DETECTED", "TOT_SEIZURES", "DETECTION_RATE", "FP_COUNT"),
        }.items()
        for column in columns
    },
    "unique_patient_id": 'select count(*) from (select "PATIENT_ID" from patient_summary'
    " group by 1 having count(*) > 1)",
    "accepted_alert_reason": _where(
        "alert_reason not in ('spike_threshold', 'high_variance')", "alerts"
    ),
    "unique_alerts_daily": 'select count(*) from (select "PATIENT_ID", "CHANNEL", "ALERT_DATE"'
    " from alerts_daily group by all having count(*) > 1)",
    "detection_rate_between_0_and_100": _where(
        "cast(rtrim(\"DETECTION_RATE\", '%') as float) not between 0 and 100",
        "seizure_detection_rate",
    ),
}

DETECTION = {
    "detected": "select count(distinct recording_file) from pairs",
    "total_seizures": "select count(*) from annotations",
    "false_positives": "select count(*) from in_vain",
    "total_alerts": "select count(*) from alerts",
}
DAILY_RUN = {
    **{
        name: {"rows": f"select count(*) from {name}"}
        for name in ("annotations", "features", "patient_summary", "alerts_daily", "seizure_detection_rate")
    },
    "detection_report": {
        "rows": "select 1",
        **DETECTION,
        "detection_rate": f"select ({DETECTION['detected']}) * 100.0::double / ({DETECTION['total_seizures']})",
        "false_positive_rate": f"select ({DETECTION['false_positives']}) * 100.0::double / ({DETECTION['total_alerts']})",
    },
    "quality_report": {
        "rows": "select 15",
        "schema_check": "select 0",
        **ROW_CHECKS,
        **GROUP_CHECKS,
        "gap_check": "select count(*) from gaps",
    },
    "mart_constraints": {"rows": f"select {len(MART_CHECKS)}", **MART_CHECKS},
}

# Windows that have closed when the stream's last event has arrived.
CLOSED = """,
closed as (
  select * from labelled
  where window_end <= (select date_trunc('millisecond', max(event_time)) from readings) - interval 3 second
)"""

# Readings in three deliveries; rows are late whose window has closed by what was delivered before.
DELIVERED = """,
delivered as (
  select *, case when event_id % 7 = 0 then 2 when day(event_time) <= 10 then 0 else 1 end as delivery,
         time_bucket(interval 7 day, event_time, timestamp '1970-01-01') + interval 7 day as window_end
  from readings
),
judged as (
  select *, window_end <= (select date_trunc('millisecond', max(event_time)) - interval 3 second
                           from delivered e where e.delivery < d.delivery) as late
  from delivered d
)"""

ALL_READINGS = """select patient_id, epoch_us(event_time) // 1000 as timestamp_ms,
cast(event_id as integer) as sample_index, channel, voltage from readings"""

ORACLES: dict[str, str] = {
    "window_features": _select(FEATURES, f"select {_ALERT_COLUMNS} from features"),
    "alert_label": _select(LABELLED, f"select {_ALERT_COLUMNS}, alert_reason from labelled"),
    "alerts": _select(LABELLED, f"select {_ALERT_COLUMNS}, alert_reason from alerts"),
    "wire_roundtrip": _select(
        READINGS,
        """select patient_id, epoch_ms(date_trunc('day', event_time)) as timestamp_ms,
        cast(row_number() over (partition by patient_id, channel, date_trunc('day', event_time)
                                order by event_time, event_id) - 1 as integer) as sample_index,
        channel, voltage from readings""",
    ),
    "parse_explode": _select(READINGS, ALL_READINGS),
    "overlap_join": _select(
        LABELLED + ANNOTATIONS + PAIRS,
        f"select {_ALERT_COLUMNS}, alert_reason, recording_file, seizure_start_ms, seizure_end_ms"
        " from pairs",
    ),
    "overlap_join_bucketed": _select(
        LABELLED + ANNOTATIONS + PAIRS,
        "select patient_id, channel, window_start, window_end, recording_file, seizure_start_ms,"
        " seizure_end_ms from pairs",
    ),
    "overlap_anti": _select(
        LABELLED + ANNOTATIONS + PAIRS, f"select {_ALERT_COLUMNS}, alert_reason from in_vain"
    ),
    "detected_seizures": _select(
        LABELLED + ANNOTATIONS + PAIRS,
        "select distinct patient_id, recording_file, seizure_start_ms, seizure_end_ms from pairs",
    ),
    "detection_report": _select(
        LABELLED + ANNOTATIONS + PAIRS,
        """select detected, total_seizures, false_positives, total_alerts,
        round(detected * 100.0::double / total_seizures, 6) as detection_rate,
        round(false_positives * 100.0::double / total_alerts, 6) as false_positive_rate
        from (select (select count(distinct recording_file) from pairs) as detected,
                     (select count(*) from annotations) as total_seizures,
                     (select count(*) from in_vain) as false_positives,
                     (select count(*) from alerts) as total_alerts)""",
    ),
    "slice_around_events": _select(
        READINGS + ANNOTATIONS,
        """select r.*, s.recording_file, s.seizure_start_ms, s.seizure_end_ms
        from readings r join annotations s
          on r.patient_id = s.patient_id
         and r.event_time >= s.seizure_start_ms - interval 30 minute
         and r.event_time < s.seizure_end_ms + interval 30 minute""",
    ),
    "patient_summary": _select(
        LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from patient_summary"
    ),
    "alerts_daily": _select(LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from alerts_daily"),
    "seizure_detection_rate": _select(
        LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from seizure_detection_rate"
    ),
    "mart_constraints": _report(LABELLED + ANNOTATIONS + PAIRS + MARTS, MART_CHECKS),
    "bucketed_summary": _select(LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from patient_summary"),
    "marts_incremental": _select(
        LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from patient_summary"
    ),
    "alerts_incremental": _select(LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from alerts_daily"),
    "distinct_by_day": _select(
        FEATURES + ",\ndays as (select distinct event_date from features)",
        """select d.event_date, count(distinct patient_id) filter (f.event_date = d.event_date) as on_day,
        count(distinct patient_id) filter (f.event_date > d.event_date - 10) as lately,
        count(distinct patient_id) as so_far
        from days d join features f on f.event_date <= d.event_date group by d.event_date""",
    ),
    "daily_run": _select(
        LABELLED + ANNOTATIONS + PAIRS + MARTS + GAPS,
        "\nunion all ".join(
            f"select '{step}' as step, '{metric}' as metric, round(({query})::double, 6) as value"
            for step, metrics in DAILY_RUN.items()
            for metric, query in metrics.items()
        ),
    ),
    "dq_row_checks": _report(FEATURES, ROW_CHECKS, one=("distinct_duration_check",)),
    "dq_channel_count": _select(
        FEATURES,
        "select patient_id, window_start, count(*) as n from features group by all having n <> 5",
    ),
    "dq_duplicates": _select(
        READINGS,
        """select patient_id, channel,
        time_bucket(interval 7 day, event_time, timestamp '1970-01-01') as window_start, count(*) as n
        from readings group by all having n > 1""",
    ),
    "gap_check": _select(FEATURES + GAPS, "select * from gaps"),
    "dq_report": _report(
        FEATURES + GAPS,
        {
            "schema_check": "select 0",
            **ROW_CHECKS,
            **GROUP_CHECKS,
            "gap_check": "select count(*) from gaps",
        },
        one=("distinct_duration_check",),
    ),
    "signal_profile": _select(
        READINGS,
        """select patient_id, channel, count(*) as samples, min(event_time) as first_time,
        max(event_time) as last_time, min(voltage) as min_v, max(voltage) as max_v,
        round(count(*) / (date_diff('microsecond', min(event_time), max(event_time)) / 1e6), 6)
          as samples_per_second
        from readings group by 1, 2""",
    ),
    "band_power": _select(
        READINGS
        + """,
timed as (
  select patient_id, channel, voltage,
         time_bucket(interval 7 day, event_time, timestamp '1970-01-01') as window_start,
         date_diff('microsecond', window_start, event_time) / 6048e8 as part
  from readings
)""",
        """select patient_id, channel, window_start, count(*) as samples, cast(k as integer) as cycles,
        round((pow(sum(voltage * cos(2 * pi() * k * part)), 2)
             + pow(sum(voltage * sin(2 * pi() * k * part)), 2)) / count(*), 4) as power
        from timed, range(1, 17) as frequencies(k) group by all""",
    ),
    "power_density": _select(
        READINGS
        + """,
samples as (select channel, voltage, row_number() over (partition by channel order by event_time, event_id) - 1 as i
            from readings),
segments as (
  select channel, i // 32 - back as segment, i - 32 * (i // 32 - back) as place, voltage
  from samples, range(2) as b(back) where i // 32 - back >= 0),
tapered as (
  select channel, segment, place, (voltage - avg(voltage) over whole) * (0.5 - 0.5 * cos(2 * pi() * place / 64)) as x
  from segments window whole as (partition by channel, segment) qualify count(*) over whole = 64),
powers as (
  select channel, segment, k, pow(sum(x * cos(2 * pi() * k * place / 64)), 2)
       + pow(sum(x * sin(2 * pi() * k * place / 64)), 2) as power
  from tapered, range(33) as frequencies(k) group by all)""",
        """select channel, cast(k as integer) as cycles, count(*) as segments,
        round(avg(power) * case when k in (0, 32) then 1 else 2 end / 24, 6) as density
        from powers group by channel, k""",
    ),
    "channel_normalise": """
        select recording, electrode, min(position) as position, arg_min(label, position) as label
        from (select p_brand as recording, p_partkey as position, p_name as label,
                     upper(left(w, 1)) || lower(substr(w, 2)) as electrode
              from (select *, regexp_extract(p_name, '\\w+') as w from part))
        group by recording, electrode""",
    "channel_dedupe_suffix": """
        select p_brand as recording, p_partkey as position, p_name as label,
               case when count(*) over same > 1
                    then p_name || '-' || (row_number() over (same order by p_partkey) - 1)
                    else p_name end as channel
        from part window same as (partition by p_brand, p_name)""",
    "annotation_text": _select(
        READINGS + ANNOTATIONS,
        """select patient_id, patient_id || '_' || recording_file as recording_file,
        seizure_start_ms, seizure_end_ms from annotations""",
    ),
    "recording_headers": _select(
        READINGS,
        """select patient_id || '_' || event_id as recording_file, patient_id,
        date_trunc('second', event_time) as started_at, cast(2 as bigint) as records,
        1.0::double as sampling_rate, 2 as signals from readings""",
    ),
    "recording_samples": _select(
        READINGS
        + """,
steps as (
  select patient_id || '_' || event_id as recording_file, channel,
         epoch_us(event_time) // 1000000 * 1000 as started_ms, floor(voltage * 50) as step
  from readings
)""",
        """select recording_file, channel || '-' || signal as channel, cast(second as integer) as sample_index,
        started_ms + 1000 * second as timestamp_ms,
        round((1 - 2 * second) * (case when signal = 0 then step else floor(step / 2) end) * 0.02::double, 6)
          as millivolts
        from steps, range(2) as s(second), range(2) as i(signal)""",
    ),
    "recording_source": _select(
        READINGS
        + """,
steps as (
  select patient_id, floor(voltage * 50) as step,
         row_number() over (partition by patient_id order by event_time, event_id) - 1 as place
  from readings
)""",
        """select patient_id, patient_id || '_all.edf' as recording_file, 'signal-' || signal as channel,
        cast(place as integer) as sample_index, 1704067200000 + 1000 * place as timestamp_ms,
        round((case when signal = 0 then step else floor(step / 2) end) * 0.02::double, 6) as millivolts
        from steps, range(2) as i(signal)""",
    ),
    "recording_scan": _select(
        READINGS,
        """select patient_id || '_all.edf' as recording_file, patient_id, count(*) as records,
        1.0::double as sampling_rate, 768 + 4 * count(*) as size, 'open' as problem, 2 as signals
        from readings group by 2""",
    ),
    "staged_mart": _select(
        LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from patient_summary"
    ),
    "table_roundtrip": _select(FEATURES, f"select {_ALERT_COLUMNS} from features"),
    "conditional_delete": _select(
        FEATURES, f"select {_ALERT_COLUMNS} from features where spike_count = 0"
    ),
    "stream_features": _select(LABELLED + CLOSED, f"select {_ALERT_COLUMNS} from closed"),
    "mart_table": _select(LABELLED + ANNOTATIONS + PAIRS + MARTS, "select * from patient_summary"),
    "partition_scan": _select(
        FEATURES,
        f"select {_ALERT_COLUMNS} from features where patient_id = 'chb01' and event_date = '2024-01-11'",
    ),
    "stream_two_feeds": _select(
        LABELLED + CLOSED,
        f"select {_ALERT_COLUMNS} from closed union all select {_ALERT_COLUMNS} from closed",
    ),
    "stream_recovery": _select(
        LABELLED + CLOSED,
        f"""select {_ALERT_COLUMNS}, null::varchar as alert_reason, 'features' as sink from closed
        union all select {_ALERT_COLUMNS}, alert_reason, 'alerts' from closed where alert_reason is not null""",
    ),
    "stream_late_rows": _select(
        READINGS + DELIVERED,
        f"""{ALL_READINGS.replace("from readings", "")}, date_trunc('millisecond', event_time) as event_time, window_end
        from judged where late""",
    ),
    "stream_gaps": _select(
        LABELLED + CLOSED,
        """select patient_id, channel, 'gap' as kind, window_start, prev_end from (
          select *, lag(window_end) over (partition by patient_id, channel order by window_start) as prev_end from closed
        ) where window_start <> prev_end
        union all
        select patient_id, channel, 'silent', null, max(window_end) from features group by all
        having max(window_end) + interval 10 day
          <= (select date_trunc('millisecond', max(event_time)) from readings) - interval 3 second""",
    ),
    "stream_alerts": _select(
        LABELLED + CLOSED,
        f"select {_ALERT_COLUMNS}, alert_reason from closed where alert_reason is not null",
    ),
}
ORACLES["wire_repeats"] = ORACLES["wire_roundtrip"]
