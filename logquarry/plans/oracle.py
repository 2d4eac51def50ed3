"""The same results in plain SQL, to check every query against another engine."""

from __future__ import annotations

from logquarry.functions import patterns as P
from logquarry.plans.catalog import BATCH_LABELS, CHUNK_SIZE, FIRST_RUN, LATEST_RUN, UNKNOWN_RUN
from logquarry.sources.corpus import CORPUS_SQL

_EDGES = "' ' || " + " || ".join(f"chr({i})" for i in range(1, 32))
_METHODS = ", ".join(f"'{m}'" for m in P.METHODS)
_LABEL = "case batch_id " + " ".join(f"when {i} then '{x}'" for i, x in BATCH_LABELS.items()) + " end"


def _group(pattern: str, text: str, i: int) -> str:
    return f"regexp_extract({text}, '{pattern}', {i})"


def _decoded(path: str) -> str:
    return (
        f"case when regexp_matches({path}, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)') then {path} "
        f"else url_decode(replace({path}, '+', ' ')) end"
    )


def _printable(path: str) -> str:
    return f"trim(regexp_replace({path}, '{P.NON_PRINTABLE}', '', 'g'))"


def _rate(errors: str, total: str) -> str:
    return f"round(({errors}::double / {total})::decimal(18,10), 5)::double"


_STEPS = {
    "lines": f"select batch_id, line from ({CORPUS_SQL.format(STR='varchar', TS="strftime(ts, '%d/%b/%Y:%H:%M:%S')", EVENTS='events')}) c",
    "edged": f"select batch_id, line as whole, trim(line, {_EDGES}) as line from lines",
    "clean": "select batch_id, line from edged where line <> ''",
    "split": f"""select batch_id, line, regexp_matches(line, '{P.CLF_LINE}') as fits,
        {_group(P.CLF_LINE, 'line', 1)} as host, {_group(P.CLF_LINE, 'line', 2)} as log_time,
        {_group(P.CLF_LINE, 'line', 3)} as request, {_group(P.CLF_LINE, 'line', 4)} as status,
        {_group(P.CLF_LINE, 'line', 5)} as bytes_text from clean""",
    "parsed": """select batch_id, host, log_time, request, status::int as status_code, bytes_text,
        greatest(coalesce(try_cast(bytes_text as bigint), 0), 0) as bytes,
        split_part(log_time, ':', 1) as log_date,
        try_cast(split_part(log_time, ':', 2) as int) as log_hour from split where fits""",
    "requests": f"""select batch_id, host, request, status_code, bytes, {_group(P.CLF_REQUEST, 'request', 1)} as method,
        {_group(P.CLF_REQUEST, 'request', 2)} as path,
        nullif({_group(P.CLF_REQUEST, 'request', 3)}, '') as protocol
        from parsed where regexp_matches(request, '{P.CLF_REQUEST}')""",
    "counted": f"select * from requests where method in ({_METHODS})",
    "cleaned": f"select *, {_printable(_decoded('path'))} as resource_path from counted",
    "resources": "select * from cleaned where starts_with(resource_path, '/')",
    "partials": """select batch_id, resource_path, host, count(*) as req_count,
        sum(bytes)::decimal(38,0) as bytes from resources group by all""",
    "totals": """select resource_path, count(*) as request_count, sum(bytes)::decimal(38,0) as total_bytes,
        count(distinct host) as distinct_hosts from resources group by all""",
    "hours": f"select *, status_code between {P.ERROR_LOW} and {P.ERROR_HIGH} as bad from parsed where log_hour is not null",
    "daily": """select log_date, status_code, count(*) as request_count,
        sum(bytes)::decimal(38,0) as total_bytes from parsed group by all""",
    "daily_batches": """select batch_id, log_date, status_code, count(*) as request_count,
        sum(bytes)::decimal(38,0) as total_bytes from parsed group by all""",
    "hourly": f"""select log_date, log_hour, count(*) as total_requests,
        count(*) filter (where bad) as error_request_count,
        count(distinct host) filter (where bad) as distinct_error_hosts,
        {_rate('(count(*) filter (where bad))', 'count(*)')} as error_rate,
        (count(*) filter (where bad))::double / count(*) as error_rate_raw from hours group by all""",
    "hourly_batches": f"""select batch_id, log_date, log_hour, count(*) as total_requests,
        count(*) filter (where bad) as error_request_count,
        count(distinct host) filter (where bad) as distinct_error_hosts,
        {_rate('(count(*) filter (where bad))', 'count(*)')} as error_rate,
        (count(*) filter (where bad))::double / count(*) as error_rate_raw from hours group by all""",
    "quality": f"""select batch_id, count(*) as total_lines,
        count(*) filter (where line = '') as blank_lines,
        count(*) filter (where line <> '' and not regexp_matches(line, '{P.CLF_LINE}')) as malformed,
        count(*) filter (where regexp_matches(line, '{P.CLF_LINE}')) as records_processed,
        sum(octet_length(encode(whole)) + 1)::bigint as batch_bytes from edged group by all""",
}


def _with(select: str) -> str:
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in _STEPS.items()) + "\n" + select


def _top(rows: str) -> str:
    return f"{rows} order by request_count desc, resource_path limit {P.TOP_RESOURCES}"


def _schema_on_read(shape: str) -> str:
    pattern, names = P.READ_SHAPES[shape]
    columns = ", ".join(
        f"case when regexp_matches(line, '{pattern}') then {_group(pattern, 'line', i)} end as {n}"
        for i, n in enumerate(names, start=1)
    )
    return f"select batch_id, {columns} from lines"


def _strict(shape: str) -> str:
    pattern, names = P.READ_SHAPES[shape]
    columns = ", ".join(f"{_group(pattern, 'line', i)} as {n}" for i, n in enumerate(names, 1))
    return f"(select {columns} from lines where regexp_matches(line, '{pattern}'))"


_STRICT_BYTES = "greatest(coalesce(try_cast(bytes as bigint), 0), 0)"


def _by_path(path_select: str) -> str:
    return f"""select resource_path, count(*) as request_count, sum(bytes)::decimal(38,0) as total_bytes,
        count(distinct host) as distinct_hosts from ({path_select}) group by all"""


def _hourly_over(rows: str, bad: str) -> str:
    return f"""select log_date, log_hour::int as log_hour, count(*) as total_requests,
        count(*) filter (where {bad}) as error_request_count,
        count(distinct host) filter (where {bad}) as distinct_error_hosts,
        {_rate(f'(count(*) filter (where {bad}))', 'count(*)')} as error_rate,
        (count(*) filter (where {bad}))::double / count(*) as error_rate_raw
        from {rows} group by all"""


def _audit() -> str:
    rows = []
    for name, (pattern, _) in P.READ_SHAPES.items():
        source = "(select batch_id, line from clean)" if name == "lenient" else "lines"
        rows.append(
            f"""select batch_id, '{name}' as profile,
            count(*) filter (where not regexp_matches(line, '{pattern}')) as malformed_count,
            count(*) filter (where regexp_matches(line, '{pattern}')) as kept_count
            from {source} group by batch_id"""
        )
    return " union all ".join(rows)


def _results(batches: str) -> str:
    """All questions of one run over the given batches, as one wide table."""
    return f"""
    select batch_id, 'Q1' as query_name, log_date, null::int as log_hour, status_code,
        null::varchar as resource_path, request_count, total_bytes, null::bigint as distinct_hosts,
        null::bigint as error_request_count, null::bigint as total_requests,
        null::double as error_rate, null::bigint as distinct_error_hosts
        from daily_batches where batch_id in ({batches})
    union all select null, 'Q2', null, null, null, resource_path, request_count, total_bytes,
        distinct_hosts, null, null, null, null from (
            select resource_path, sum(req_count)::bigint as request_count,
                sum(bytes)::decimal(38,0) as total_bytes, count(distinct host) as distinct_hosts
            from partials where batch_id in ({batches}) group by all
            order by request_count desc, resource_path limit {P.TOP_RESOURCES})
    union all select batch_id, 'Q3', log_date, log_hour, null, null, null, null, null,
        error_request_count, total_requests, error_rate, distinct_error_hosts
        from hourly_batches where batch_id in ({batches})"""


_ALL = ", ".join(map(str, BATCH_LABELS))
_RUNS = {FIRST_RUN: "1", LATEST_RUN: _ALL}
_QUESTIONS = "(select unnest(['Q1', 'Q2', 'Q3']) as query_name)"


def _both_runs(select) -> str:
    return " union all ".join(
        f"select {run}::bigint as run_id, r.* from ({select(batches)}) r"
        for run, batches in _RUNS.items()
    )


def _batch_rows(batches: str) -> str:
    return f"""
    select query_name, batch_id, {_LABEL} as batch_label, 'all_batches' as stage,
        total_lines as batch_size, (avg(total_lines) over ())::decimal(20,2) as average_batch_size,
        batch_bytes, blank_lines, malformed as malformed_lines, records_processed
        from quality where batch_id in ({batches})"""


def _batch_metadata(batches: str) -> str:
    per_question = f"""select q.query_name, b.* from {_QUESTIONS} q,
        ({_batch_rows(batches).replace('query_name, ', '', 1)}) b"""
    merges = f"""select query_name, null, null, 'merge', null, null, null, null, null, null
        from {_QUESTIONS} q"""
    return f"{per_question} union all {merges}"


_PACKED = f"""
    select 'Q1' as query_name, log_date || '_' || status_code as packed_key,
        request_count || '_' || total_bytes as packed_value from daily
    union all select 'Q2', resource_path,
        request_count || '_' || total_bytes || '_' || distinct_hosts from totals
    union all select 'Q3', log_date || '_' || printf('%02d', log_hour),
        total_requests || '_' || error_request_count || '_' || printf('%.5f', error_rate)
        || '_' || distinct_error_hosts from hourly"""

_DECODED = """
    select 'Q1' as query_name, log_date, status_code, null::int as log_hour,
        null::varchar as resource_path, request_count, total_bytes, null::bigint as distinct_hosts,
        null::bigint as total_requests, null::bigint as error_request_count,
        null::double as error_rate, null::bigint as distinct_error_hosts,
        null::varchar as _corrupt from daily
    union all select 'Q2', null, null, null, resource_path, request_count, total_bytes,
        distinct_hosts, null, null, null, null, null from totals
    union all select 'Q3', log_date, null, log_hour, null, null, null, null, total_requests,
        error_request_count, error_rate, distinct_error_hosts, null from hourly
    union all select q, null, null, null, null, null, null, null, null, null, null, null,
        'damaged' || chr(9) || line from split, (select unnest(['Q1', 'Q2', 'Q3']) as q) where not fits"""

_HOST_SETS = """
    select batch_id, substr(md5(host), 1, 2) as host_part, resource_path, sum(req_count)::bigint as request_count,
        sum(bytes)::decimal(38,0) as total_bytes, string_agg(host, '#' order by host) as hosts
        from partials group by all"""

_ROLLUP = f"""
    select 'lines' as part, e.batch_id, case when e.line = '' then 'blank'
            when p.fits then 'parsed' else 'malformed' end as line_kind,
        case when fits then split_part(log_time, ':', 1) end as log_date,
        case when fits then try_cast(split_part(log_time, ':', 2) as int) end as log_hour,
        try_cast(status as int) as status_code, null::varchar as resource_path,
        case when try_cast(status as int) between {P.ERROR_LOW} and {P.ERROR_HIGH} then p.host end as host,
        count(*) as req_count,
        sum(case when fits then greatest(coalesce(try_cast(bytes_text as bigint), 0), 0) end)::decimal(38,0) as bytes,
        count(*) filter (where try_cast(status as int) between {P.ERROR_LOW} and {P.ERROR_HIGH}) as error_count
        from (select batch_id, line from edged) e
        left join (select distinct * from split) p on e.batch_id = p.batch_id and e.line = p.line
        group by all
    union all select 'requests', batch_id, null, null, null, null, resource_path, host, count(*),
        sum(bytes)::decimal(38,0), count(*) filter (where status_code between {P.ERROR_LOW} and {P.ERROR_HIGH})
        from resources group by all"""

_CHUNKS = f"""
    select (i // {CHUNK_SIZE} + 1)::int as batch_id, count(*) as line_count,
        min(i) as first_index, max(i) as last_index, count(distinct i) as indexes
        from (select row_number() over () - 1 as i from lines) group by all"""

def _differing(first: str, second: str, keys: tuple[str, ...], measures: tuple[str, ...]) -> str:
    """Groups in which two selects differ."""
    same = " and ".join(f"a.{k} is not distinct from b.{k}" for k in keys)
    differs = " or ".join(f"a.{m} is distinct from b.{m}" for m in measures)
    shown = ", ".join(f"a.{m} as {m}_first, b.{m} as {m}_second" for m in measures)
    picked = ", ".join(f"coalesce(a.{k}, b.{k}) as {k}" for k in keys)
    return f"select {picked}, {shown} from ({first}) a full join ({second}) b on {same} where {differs}"


_STRICT_DAILY_GROUPS = f"""select substr(log_time, 1, 11) as log_date, status::int as status_code,
        count(*) as request_count, sum({_STRICT_BYTES})::decimal(38,0) as total_bytes
        from {_strict('strict_daily')} group by all"""

_STRICT_TOTALS = _by_path(f"""select host, path as resource_path, {_STRICT_BYTES} as bytes
        from {_strict('strict_resources')} where method in ({_METHODS}) and path like '/%'""")

_PARITY_LINES = f"""
    select batch_id, line, case when lenient then 'lenient' else 'strict_resources' end as kept_by, count(*) as line_count
    from (select batch_id, whole as line, regexp_matches(line, '{P.CLF_LINE}') as lenient,
                 regexp_matches(whole, '{P.STRICT_RESOURCES}') as strict from edged)
    where lenient <> strict group by all"""

_FIRST_RESULTS = f"(select query_name, count(*)::bigint as n from ({_results('1')}) group by query_name)"
_INTEGRITY = f"""
    select 'orphan_run' as fault, 'query_results' as table_name, {UNKNOWN_RUN}::bigint as run_id, query_name,
        n::decimal(38,0)::bigint as row_count from {_FIRST_RESULTS} where query_name = 'Q1'
    union all select 'orphan_batch', 'query_results', {UNKNOWN_RUN}, query_name, n from {_FIRST_RESULTS} where query_name = 'Q1'
    union all select 'orphan_batch', 'query_results', {FIRST_RUN}, query_name, n from {_FIRST_RESULTS} where query_name = 'Q1'
    union all select 'repeated_group', 'query_results', {FIRST_RUN}, query_name, n from {_FIRST_RESULTS} where query_name = 'Q2'
    union all select 'null_key', 'malformed_record_summary', {LATEST_RUN}, 'Q1', 1"""

ORACLE: dict[str, str] = {
    "sql_log_view": f"select * from ({_schema_on_read('strict_resources')}) where host is not null and method <> 'HEAD'",
    "parse_observed": "select * from quality",
    "parity_lines": _PARITY_LINES,
    "parity_q1": _differing("select * from daily", _STRICT_DAILY_GROUPS, ("log_date", "status_code"), ("request_count", "total_bytes")),
    "parity_q2": _differing("select * from totals", _STRICT_TOTALS, ("resource_path",), ("request_count", "total_bytes", "distinct_hosts")),
    "parity_q3": _differing("select * from hourly", _hourly_over(_strict("strict_hourly"), f"status::int >= {P.ERROR_LOW}"),
        ("log_date", "log_hour"), ("total_requests", "error_request_count", "distinct_error_hosts")),
    "store_integrity": _INTEGRITY,
    "scan_lines": "select line from lines",
    "scan_recursive": "select line from lines",
    "scan_batches": f"select batch_id, {_LABEL} as batch_label, line from lines",
    "scan_one_batch": "select 1 as batch_id, 'August' as batch_label, line from lines where batch_id = 2",
    "chunk_lines": _CHUNKS,
    "hive_schema_on_read": _schema_on_read("strict_resources"),
    "schema_on_read_daily": _schema_on_read("strict_daily"),
    "schema_on_read_hourly": _schema_on_read("strict_hourly"),
    "schema_on_read_clock": _schema_on_read("clock_hourly"),
    "results_for_run": f"select {FIRST_RUN}::bigint as run_id, 'Q1' as query_name, * from daily_batches where batch_id = 1",
    "tsv_roundtrip": "select * from partials",
    "out_replace": "select * from daily",
    "merge_upsert": "select * from partials",
    "merge_partial_correction": """
        select batch_id, resource_path, host, case when batch_id = 2 and req_count > 1 then req_count * 2 else req_count end as req_count, bytes
        from partials where not (batch_id = 1 and bytes = 0)
        union all select batch_id, resource_path || '/new', host, req_count, bytes
        from partials where batch_id = 2 and req_count > 1""",
    "merge_emptied": "select * from partials where batch_id = 1",
    "malformed_quarantine": "select batch_id, line from split where not fits",
    "packed_encode": _PACKED,
    "packed_decode": _DECODED,
    "lines_clean": "select batch_id, line from clean",
    "clf_parse": "select batch_id, host, log_time, request, status_code, bytes, log_date, log_hour from parsed",
    "malformed_lines": "select batch_id, line from split where not fits",
    "request_parse": "select batch_id, request, method, path, protocol from requests",
    "request_filter": "select batch_id, host, method, resource_path, bytes from resources",
    "path_normalize": f"select batch_id, path, {_printable(_decoded('path'))} as resource_path from requests",
    "bytes_coerce": "select batch_id, bytes_text, bytes from parsed",
    "bytes_union_branches": """select case when bytes_text = '-' then 'dash' when bytes_text = '' then 'empty'
        when try_cast(bytes_text as bigint) >= 0 then 'valid' else 'other' end as byte_branch,
        log_date, status_code, count(*) as request_count, sum(bytes)::decimal(38,0) as total_bytes
        from parsed group by all""",
    "log_date_hour": "select batch_id, log_time, log_date, log_hour from parsed",
    "error_flag": f"""select batch_id, status_code,
        case when status_code between {P.ERROR_LOW} and {P.ERROR_HIGH} then 1 else 0 end as is_error,
        case when status_code >= {P.ERROR_LOW} then 1 else 0 end as is_error_ge400 from parsed""",
    "parse_quality": """select *, total_lines as batch_size,
        (avg(total_lines) over ())::decimal(20,2) as average_batch_size from quality""",
    "parity_audit": _audit(),
    "q1_by_batch": "select * from daily_batches",
    "q1_daily_status": "select * from daily",
    "q1_strict": f"""select substr(log_time, 1, 11) as log_date, status::int as status_code,
        count(*) as request_count, sum({_STRICT_BYTES})::decimal(38,0) as total_bytes
        from {_strict('strict_daily')} group by all""",
    "q2_stage1": "select * from partials",
    "q2_stage1_hostset": _HOST_SETS,
    "q2_stage2": "select * from totals",
    "q2_stage2_top20": _top("select * from totals"),
    "q2_tokenized_merge": "select * from totals",
    "q2_hostset_union": """select substr(md5(host), 1, 2) as host_part, resource_path, count(distinct host) as host_count,
        string_agg(distinct host, '#' order by host) as hosts from resources group by all""",
    "q2_resources": "select * from totals",
    "q2_top20": _top("select * from totals"),
    "q2_path_raw": _by_path("select host, bytes, path as resource_path from counted where starts_with(path, '/')"),
    "q2_path_printable": _by_path(
        f"select host, bytes, {_printable('path')} as resource_path from counted where starts_with(path, '/')"
    ),
    "q2_strict": _top(_by_path(f"""select host, path as resource_path, {_STRICT_BYTES} as bytes
        from {_strict('strict_resources')} where method in ({_METHODS}) and path like '/%'""")),
    "q3_by_batch": "select * from hourly_batches",
    "q3_two_phase": "select * from hourly",
    "q3_hourly_errors": "select * from hourly",
    "q3_ge400": _hourly_over("(select * from parsed where log_hour is not null)", f"status_code >= {P.ERROR_LOW}"),
    "q3_strict": _hourly_over(_strict("strict_hourly"), f"status::int >= {P.ERROR_LOW}"),
    "q3_clock": _hourly_over(_strict("clock_hourly"), f"status::int >= {P.ERROR_LOW}"),
    "query_results_wide": _both_runs(_results),
    "store_tables": _both_runs(_results),
    "run_metadata": f"""select run_id, 'spark' as pipeline_name, count(*) as result_rows
        from ({_both_runs(_results)}) group by run_id""",
    "batch_metadata": _both_runs(_batch_metadata),
    "malformed_record_summary": _both_runs(
        lambda b: f"""select query_name, batch_id, malformed as malformed_record_count
            from quality, {_QUESTIONS} where batch_id in ({b})"""
    ),
    "report_q1": "select * from daily",
    "report_q2": f"""select case when length(resource_path) > {P.REPORT_PATH_WIDTH}
        then substr(resource_path, 1, {P.REPORT_PATH_KEPT}) || '...' else resource_path end as resource_path,
        request_count, total_bytes, distinct_hosts from ({_top('select * from totals')})""",
    "report_q3": """select log_date, log_hour, sum(total_requests)::bigint as total_requests,
        sum(error_request_count)::bigint as error_request_count, round(avg(error_rate)::decimal(18,10), 5)::double as error_rate,
        sum(distinct_error_hosts)::bigint as distinct_error_hosts from hourly_batches group by all""",
    "batch_summary": f"""select q.query_name, b.batch_id, b.batch_label, b.batch_size,
        b.average_batch_size, b.records_processed from {_QUESTIONS} q,
        ({_batch_rows(_ALL).replace('query_name, ', '', 1)}) b""",
    "job_q1": f"select * from ({_results(_ALL)}) where query_name = 'Q1'",
    "job_q2": f"select * from ({_results(_ALL)}) where query_name = 'Q2'",
    "job_q3": f"select * from ({_results(_ALL)}) where query_name = 'Q3'",
    "job_all": _results(_ALL),
    "job_resumed": _results(_ALL),
    "job_rerun": f"select * from ({_results(_ALL)}) where query_name = 'Q1'",
    "job_chunks": "select * from daily",
    "job_quarantine": "select batch_id, line from split where not fits",
    "packed_import": _DECODED,
    "rollup_partials": _ROLLUP,
    "ingest_stream_top20": _top("select * from totals"),
    "ingest_compacted_top20": _top("select * from totals"),
    "ingest_maintained_top20": _top("select * from totals"),
    "ingest_nested_top20": _top("select * from totals"),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in ORACLE.items()}
