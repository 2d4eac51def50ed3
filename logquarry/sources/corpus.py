"""A Common Log Format corpus derived from the ``events`` table.

The given tables hold no access logs, so each event becomes one log line, with
every irregularity the parser must handle. The text runs unchanged on Spark and
on the SQL engine the results are checked with; only two words differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORPUS_SQL = """
select event_id, cast(event_id % 2 + 1 as int) as batch_id,
 case when event_id % 67 = 0 then ''
      when event_id % 71 = 0 then concat('garbage line ', cast(event_id as {STR}))
      when event_id % 73 = 0 then concat('  ', l, chr(9)) else l end as line
from (select event_id, concat('u', cast(user_id as {STR}), '.example.net - - [', {TS}, ' -0400] "',
   case when event_id % 47 = 0 then 'GET /two words here now'
        else concat(case when event_id % 41 = 0 then 'PUT' when event_type='purchase' then 'POST'
                         when event_type='signup' then 'HEAD' else 'GET' end, ' ',
             case when event_id % 29 = 0 then concat('/p/%7E', k) when event_id % 31 = 0 then concat('/p/a+b', k)
                  when event_id % 37 = 0 then '/bad%zz' when event_id % 43 = 0 then 'noslash'
                  else concat('/p/', k) end,
             case when event_id % 5 = 0 then '' else ' HTTP/1.0' end) end, '" ',
   case when event_id % 53 = 0 then '700'
        when event_type='error' then case when event_id % 3 = 0 then '500' else '404' end
        when event_id % 11 = 0 then '304' else '200' end, ' ',
   case when event_id % 7 = 0 then '-' when event_id % 59 = 0 then 'abc' when event_id % 61 = 0 then '-12'
        else cast(cast(floor(value*100) as bigint) as {STR}) end) as l
  from (select *, regexp_extract(props, '([0-9]+)', 1) as k from {EVENTS}) e) x
"""

BATCH_LABELS = {1: "July", 2: "August"}


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``batch_id, line`` for every event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = CORPUS_SQL.format(
        STR="string", TS="date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')", EVENTS="{events}"
    )
    return spark.sql(text, events=events).select("batch_id", "line")
