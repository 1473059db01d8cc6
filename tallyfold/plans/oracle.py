"""The SQL each catalog query is compared with."""

from __future__ import annotations

# Updates, and updates with their class, as the catalog derives them from events.
_UPDATES = """
with u as (
  select event_id as e,
         cast(floor(event_id/10) as bigint)*2147483648 + event_id%10 as seq,
         cast(floor(event_id/10) as bigint) as batch_id,
         event_id%10 as pos,
         ts,
         concat('10.0.0.', cast(user_id as varchar)) as client,
         event_type as name,
         case when event_id%17=0 then 'histogram'
              when event_id%2=0 then 'counter' else 'gauge' end as metric_type,
         case when event_id%2=0 and event_id%46<>0
              then cast(json_extract_string(props,'$.k') as bigint) end as delta,
         case when event_id%2=1 and event_id%23<>0 then value end as value
  from events
),
c as (
  select *, case when metric_type='counter' and delta is null then 'null_delta'
                 when metric_type='gauge' and value is null then 'null_value'
                 when metric_type='histogram' then 'unknown_type'
                 else 'ok' end as update_class
  from u
),
v as (select * from c where update_class='ok'),
bad as (
  select batch_id, min(pos) as first_bad from c
  where update_class in ('null_delta','null_value') group by batch_id
),
state as (
  select name, metric_type, max(gauge) as gauge_value, cast(sum(count_) as bigint) as counter_value,
         min(ts) as first_seen
  from (
    select name, metric_type, ts,
           case when metric_type='gauge' and newest=1 then value end as gauge,
           case when metric_type='counter' then delta end as count_
    from (select *, row_number() over (partition by name, metric_type order by seq desc) as newest
          from v)
  )
  group by name, metric_type
),
j as (
  select *, '{"id":"' || name || '","type":"' || metric_type || '"'
            || case when delta is null then '' else ',"delta":' || cast(delta as varchar) end
            || case when value is null then '' else ',"value":' || regexp_replace(cast(value as varchar), '\\.0$', '') end
            || '}' as body
  from c
),
bodies as (
  select batch_id, count(*) as n, max(ts) as ts,
         case when batch_id%13=4 then '[' || string_agg(body, ',' order by pos) || ']]'
              when batch_id%19=6 then '[' || string_agg(body, ',' order by pos)
                                      || ',{"id":"late","delta":1.5}]'
              when batch_id%29=8 then '[]'
              when batch_id%31=9 then '[' || string_agg(body, ',' order by pos)
                                      || ']],"items":[[{"id":"b","type":"counter","delta":7}]'
              when batch_id%7=3 then replace(replace(replace(replace(
                '[' || string_agg(body, ',' order by pos) || ']',
                '"id":', '"ID":'), '"type":', '"Type":'), '"delta":', '"DELTA":'), '"value":', '"vALUE":')
              else '[' || string_agg(body, ',' order by pos) || ']' end as body,
         (batch_id%13=4 or batch_id%19=6 or (batch_id%31=9 and batch_id%29<>8)) as malformed,
         (batch_id%29=8 and batch_id%13<>4 and batch_id%19<>6) as is_empty
  from j group by batch_id
),
judged as (
  select b.batch_id,
         case when b.batch_id%23=1 then 400 when b.malformed then 422
              when b.is_empty then 200 when bad.first_bad is not null then 500
              else 200 end as http_status,
         b.is_empty, bad.first_bad
  from bodies b left join bad on b.batch_id=bad.batch_id
),
verdicts as (
  select batch_id, http_status, is_empty,
         cast((select count(*) from c where c.batch_id=judged.batch_id
                 and metric_type<>'histogram' and http_status=200 and not is_empty)
              as bigint) as clean,
         cast((select count(*) from c where c.batch_id=judged.batch_id
                 and metric_type<>'histogram' and http_status=500 and pos<first_bad)
              as bigint) as prefix,
         case when http_status=200 then
           case when is_empty then '' else
             (select string_agg(name, ',' order by pos) from c where c.batch_id=judged.batch_id)
           end end as audit_ids
  from judged
)
"""

_VALUE_TEXT = (
    "case when metric_type='counter' then cast(counter_value as varchar) "
    "when metric_type='gauge' then regexp_replace(cast(gauge_value as varchar), '\\.0$', '') "
    "else '' end"
)
_ROW = "seq, batch_id, pos, ts, client, name, metric_type, delta, value, update_class"
_BARE_ROW = "seq, batch_id, pos, ts, client, name, metric_type, delta, value"
_NEWEST = """
select {columns} from (
  select *, {window} row_number() over (partition by {keys} order by seq desc) as newest from v
) where newest=1
"""
_HOURLY = "time_bucket(interval '1 hour', ts)"
_AUDIT_BATCH = """
  select batch_id, cast(floor(epoch(max(ts))) as bigint) as ts,
         string_agg(name, ',' order by pos) as metrics,
         min(case when pos=0 then client end) as ip_address
  from c where batch_id not in (select batch_id from bad) group by batch_id
"""
_AUDIT_SINGLE = """
  select cast(floor(epoch(ts)) as bigint) as ts, name as metrics, client as ip_address from v
"""
_REPORTS = f"""
  select window_start, client, name, metric_type, delta, value, seq from (
    select *, row_number() over (partition by window_start, client, name order by seq desc) as newest
    from (select *, {_HOURLY} as window_start from v)
  ) where newest=1
"""
_POLLS = f"select {_HOURLY} as window_start, client, count(*) as polls from u group by 1, 2"
_STATE_VALUES = "select name, metric_type, gauge_value, counter_value from state"
_OUTGOING = """
  select client, chunk, count(*) as updates,
         '[' || string_agg(body, ',' order by seq) || ']' as body
  from (select *, cast((row_number() over (partition by client order by seq)-1)//100 as bigint) as chunk
        from j where update_class='ok')
  group by client, chunk
"""
_BATCHES = f"select *, sha256(body || 'key') as digest from ({_OUTGOING})"
_CLASSES = "select update_class, count(*) as updates from c group by update_class"

_BROKEN_JSON = "e%31=5 or e%37=3 or e%41=7 or e%43=9 or e%53=2 or e%59=1"

_INGESTED = """
        , applied as (
          select c.* from c join judged on c.batch_id=judged.batch_id
          where (http_status=200 {or_prefix}) and not is_empty and update_class='ok'
        )
        select name, metric_type,
               max(case when metric_type='gauge' and newest=1 then value end) as gauge_value,
               cast(sum(case when metric_type='counter' then delta end) as bigint) as counter_value
        from (select *, row_number() over (partition by name, metric_type order by seq desc) as newest
              from applied)
        group by name, metric_type"""

_SELECTS = {
    "metrics_state": "select * from state",
    "counter_sum": "select name, counter_value from state where metric_type='counter'",
    "gauge_last": "select name, gauge_value from state where metric_type='gauge'",
    "first_seen": "select name, metric_type, first_seen from state",
    "merge_state": "select * from state",
    "latest_per_name": _NEWEST.format(
        columns="name, metric_type, delta, value, seq", window="", keys="name"
    ),
    "latest_of_any_type": _NEWEST.format(
        columns="name, metric_type, delta, value, seq", window="", keys="name"
    ).replace("from v", "from u"),
    "newest_rows": _NEWEST.format(columns=_BARE_ROW, window="", keys="name"),
    "metrics_listing": f"""
        select case when metric_type='counter' then 1 else 2 end as section, name,
               {_VALUE_TEXT} as value_text
        from state order by 1, 2""",
    "all_gauges": "select name, gauge_value from state where metric_type='gauge'",
    "all_counters": "select name, counter_value from state where metric_type='counter'",
    "point_lookup": """
        select name, gauge_value from state where metric_type='gauge' and name='click'""",
    "bulk_lookup": f"""
        select seq, name, metric_type, counter_value, gauge_value,
               case when http_status=200 then {_VALUE_TEXT} end as value_text,
               case when http_status=200 then
                 '{{"id":"' || name || '","type":"' || metric_type || '"'
                 || case when counter_value is null then '' else ',"delta":' || counter_value end
                 || case when gauge_value is null then ''
                         else ',"value":' || regexp_replace(cast(gauge_value as varchar), '\\.0$', '') end
                 || '}}' end as reply,
               http_status
        from (
          select r.*, s.counter_value, s.gauge_value,
                 case when r.metric_type<>'histogram' and s.name is null then 404 else 200 end
                   as http_status
          from (select seq, case when e%19=0 then name || '-none' else name end as name, metric_type
                from u) r
          left join state s on r.name=s.name and r.metric_type=s.metric_type
        )""",
    "update_classes": _CLASSES,
    "observed_classes": _CLASSES,
    "stream_classes": _CLASSES,
    "accepted_rows": f"select {_ROW} from c where update_class='ok'",
    "quarantined_rows": f"select {_ROW} from c where update_class<>'ok'",
    "atomic_batches": f"""
        select {_BARE_ROW} from c
        where batch_id not in (select batch_id from bad) and metric_type<>'histogram'""",
    "prefix_batches": """
        select c.seq, c.batch_id, c.pos, c.ts, c.client, c.name, c.metric_type, c.delta, c.value
        from c left join bad on c.batch_id=bad.batch_id
        where (first_bad is null or pos<first_bad) and metric_type<>'histogram'""",
    "known_type_rows": """
        select seq, name, metric_type, delta, value from u where metric_type<>'histogram'""",
    "state_violations": """
        , candidates as (
          select case when e%101=0 then 'repeated'
                      when e%103=1 then repeat('n',101) || cast(seq as varchar)
                      when e%113=5 then null
                      else name || '-' || cast(seq as varchar) end as name,
                 metric_type,
                 case when metric_type='gauge' or e%107=2 then coalesce(value,0.5) end as g,
                 case when metric_type='counter' then
                   case when e%109=3 then 3000000000 else delta end end as n
          from u
        ), counted as (
          select name, metric_type,
                 count(*) as key_not_unique,
                 count(*) filter (where name is null) as name_missing,
                 count(*) filter (where length(name)>100) as name_too_long,
                 count(*) filter (where metric_type='histogram') as type_not_allowed,
                 count(*) filter (where n not between -2147483648 and 2147483647)
                   as counter_out_of_int32,
                 count(*) filter (where not (
                     (metric_type='gauge' and g is not null and n is null) or
                     (metric_type='counter' and n is not null and g is null)))
                   as value_column_mismatch
          from candidates group by name, metric_type
        )
        select name, metric_type, 'key_not_unique' as rule, key_not_unique as "rows"
          from counted where key_not_unique>1
        union all select name, metric_type, 'name_missing', name_missing
          from counted where name_missing>0
        union all select name, metric_type, 'name_too_long', name_too_long
          from counted where name_too_long>0
        union all select name, metric_type, 'type_not_allowed', type_not_allowed
          from counted where type_not_allowed>0
        union all select name, metric_type, 'counter_out_of_int32', counter_out_of_int32
          from counted where counter_out_of_int32>0
        union all select name, metric_type, 'value_column_mismatch', value_column_mismatch
          from counted where value_column_mismatch>0""",
    "request_outcomes": """
        select form, http_status, applied, count(*) as requests from (
          select 'path' as form, case when update_class='ok' then 200 else 400 end as http_status,
                 update_class='ok' as applied
          from c where e%3=0
          union all
          select 'json', case when update_class='ok' and metric_type='counter' then 200 else 500 end,
                 update_class='ok'
          from c where e%3<>0
          union all
          select 'batch', case when count(*) filter (where update_class like 'null%')>0
                               then 500 else 200 end,
                 count(*) filter (where update_class like 'null%')=0
                   and count(*) filter (where update_class='ok')>0
          from c group by batch_id
        ) group by form, http_status, applied""",
    "json_updates": f"""
        select seq, ({_BROKEN_JSON}) as malformed,
               case when not ({_BROKEN_JSON}) then name end as name,
               case when not ({_BROKEN_JSON}) then metric_type end as metric_type,
               case when not ({_BROKEN_JSON}) then delta end as delta,
               case when not ({_BROKEN_JSON}) then value end as value
        from u""",
    "json_batches": """
        select seq, u.batch_id, pos, name, metric_type, delta, value
        from u join bodies b on u.batch_id=b.batch_id where not b.malformed and not b.is_empty""",
    "atomic_body_verdicts": """
        select batch_id, http_status, clean>0 as applied, clean as applied_updates, audit_ids
        from verdicts""",
    "prefix_body_verdicts": """
        select batch_id, http_status, clean+prefix>0 as applied, clean+prefix as applied_updates,
               audit_ids
        from verdicts""",
    "path_updates": """
        , p as (
          select e, seq, e%41=6 as lost,
                 case when e%41=6 or e%29=3 then '' else name end as name,
                 case when e%41=6 then '' else metric_type end as metric_type,
                 case when e%41<>6 and metric_type='counter' and e%37<>5 then delta end as delta,
                 case when e%41<>6 and metric_type='gauge' then
                   case when e%37=5 then 10.66 else value end end as value
          from u
        ), q as (
          select *, case when name='' then 'missing_id'
                         when metric_type='counter' and delta is null then 'bad_delta'
                         when metric_type='gauge' and value is null then 'bad_value'
                         when metric_type='histogram' then 'unknown_type'
                         else 'ok' end as update_class
          from p
        )
        select seq, name, metric_type, delta, value, update_class,
               case update_class when 'ok' then 200 when 'missing_id' then 404 else 400 end
                 as http_status,
               update_class='ok' as applied
        from q""",
    "client_ids": """
        select event_id,
               case when event_id%5=1 then '10.1.2.3'
                    when event_id%5=2 then ''
                    when event_id%4=0 then '10.0.0.' || cast(user_id as varchar)
                    when event_id%4=1 then 'fe80::' || cast(user_id as varchar)
                    when event_id%4=2 then 'fe80::' || cast(user_id as varchar)
                    else 'socket' end as client
        from events""",
    "parsed_numbers": """
        , t as (select *, json_extract_string(props,'$.k') as k from events)
        select event_id,
               case event_id%13 when 0 then cast(k as bigint)
                                when 2 then cast(k as bigint)
                                when 9 then case when cast(k as bigint)=0
                                                 then 9223372036854775807 end end as as_int,
               case event_id%13 when 0 then cast(k as double)
                                when 1 then value
                                when 2 then cast(k as double)
                                when 5 then 8.0::double
                                when 6 then case when cast(k as bigint)=0 then 0.0::double end
                                when 7 then cast('-0.' || k || 'e3' as double)
                                when 8 then cast(k || '000' as double)
                                when 9 then cast(k || '9223372036854775807' as double)
                                when 10 then cast(k as double)
                                when 12 then cast(k || 'e-1' as double) end as as_float
        from t""",
    "payload_digest": """
        select batch_id, sha256(body || 'key') as digest, batch_id%23<>1 as matches from bodies""",
    "value_texts": """
        select seq, coalesce(case when metric_type='counter' then cast(delta as varchar)
                    when metric_type='gauge' then regexp_replace(cast(value as varchar), '\\.0$', '')
                    else '' end, null) as value_text
        from u""",
    "rendered_updates": """
        select seq, case when e%7<>0 and e%11=0
                         then left(body, length(body)-1) || ',"hash":"abc"}' else body end as body
        from j""",
    "chunked_updates": """
        select seq, client,
               cast((row_number() over (partition by client order by seq)-1)//100 as bigint) as chunk
        from v""",
    "outgoing_batches": _BATCHES,
    "stream_batches": _BATCHES,
    "gzipped_bodies": """
        select name, metric_type, count(*) as updates, cast(sum(delta) as bigint) as counter_value
        from v group by name, metric_type""",
    "audit_single": _AUDIT_SINGLE,
    "audit_batch": _AUDIT_BATCH,
    "audit_file": f"select ts, metrics, ip_address from ({_AUDIT_BATCH})",
    "audit_fanout": f"""
        select a.*, s.sink from ({_AUDIT_SINGLE}) a
        cross join (select 'a' as sink union all select 'b') s""",
    "compacted_state": "select * from state",
    "state_upsert": "select * from state",
    "stored_gauges": "select name, gauge_value from state where metric_type='gauge'",
    "ingested_state": _INGESTED.format(or_prefix="or http_status=500 and pos<first_bad"),
    "stream_json_state": _INGESTED.format(or_prefix="or http_status=500 and pos<first_bad"),
    "ingested_table_state": _INGESTED.format(or_prefix=""),
    "snapshot_maps": _STATE_VALUES,
    "snapshot_file": _STATE_VALUES,
    "snapshot_document": _STATE_VALUES,
    "report_window": _REPORTS,
    "polls_per_report": _POLLS,
    "stream_state": "select * from state",
    "stream_snapshot": _STATE_VALUES,
    "stream_resume": _STATE_VALUES,
    "stream_state_changes": "select * from state",
    "stream_resume_keyed": _STATE_VALUES,
    "stream_report_window": _REPORTS,
    "stream_polls": _POLLS,
}

ORACLE_SQL = {name: _UPDATES + select for name, select in _SELECTS.items()}
