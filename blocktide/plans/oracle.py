"""The registered queries in SQL, written independently of the Spark jobs.

The close and late rules follow the event-by-event definition with a running
watermark and as-of joins, not the set-based form the jobs use.
"""

from __future__ import annotations

from blocktide import schemas as S
from blocktide.plans import queries as Q

_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _at(column: str, name: str | None = None) -> str:
    return f"strftime({column}, {_STAMP}) AS {name or column}"


FEED = """
mapped AS (
  SELECT event_id AS e, ts, value, props, user_id,
    CASE user_id % 3 WHEN 0 THEN 'ethereum' WHEN 1 THEN 'synthetic' ELSE 'solana' END AS base,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'EVENT_TYPE_TRANSACTION'
         WHEN event_type = 'signup' THEN 'EVENT_TYPE_BLOCK' ELSE 'EVENT_TYPE_LOG' END AS ty
  FROM events),
feed AS (
  SELECT e,
    CASE WHEN e % 103 = 0 THEN '' ELSE 'evt:' || base || ':' || e END AS id,
    CASE WHEN e % 107 = 0 THEN '' ELSE base END AS chain,
    CASE WHEN e % 101 = 0 THEN 'EVENT_TYPE_UNSPECIFIED' ELSE ty END AS type,
    20000000 + e // 12 AS block_number,
    '0x' || md5('b' || (e // 12)) AS block_hash,
    CASE WHEN ty = 'EVENT_TYPE_TRANSACTION' AND e % 113 <> 0
         THEN '0x' || md5(e::VARCHAR) ELSE '' END AS tx_hash,
    CASE WHEN ty = 'EVENT_TYPE_BLOCK' THEN ''
         ELSE '0x' || upper(md5('u' || user_id)) END AS from_address,
    CASE WHEN ty = 'EVENT_TYPE_TRANSACTION' THEN
           CASE e % 7 WHEN 0 THEN '0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48'
                      WHEN 1 THEN '0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2'
                      WHEN 2 THEN '' ELSE '0x' || md5('t' || (e % 50)) END
         WHEN ty = 'EVENT_TYPE_LOG' AND e % 5 = 0
           THEN '0xdAC17F958D2ee523a2206206994597C13D831ec7'
         ELSE '' END AS to_address,
    CASE WHEN ty <> 'EVENT_TYPE_TRANSACTION' THEN ''
         WHEN e % 127 = 0 THEN 'not-a-number'
         ELSE CAST(round(value * 100) AS BIGINT) || '00000000000000' END AS value_wei,
    CASE WHEN ty = 'EVENT_TYPE_TRANSACTION' THEN 21000 + e % 180000 ELSE 0 END AS gas_used,
    ts + to_seconds(e * 37 % 600 + CASE WHEN e % 29 = 0 THEN 10800 ELSE 0 END) AS observed_at,
    CASE WHEN e % 109 <> 0 THEN ts END AS block_time,
    json_extract_string(props, '$.k') AS k
  FROM mapped),
judged AS (
  SELECT *, CASE WHEN id = '' THEN 'missing_id' WHEN chain = '' THEN 'missing_chain'
    WHEN type = 'EVENT_TYPE_UNSPECIFIED' THEN 'unspecified_type'
    WHEN block_time IS NULL THEN 'missing_block_time'
    WHEN type = 'EVENT_TYPE_TRANSACTION' AND tx_hash = '' THEN 'missing_tx_hash'
    END AS reject_reason
  FROM feed),
contracts(address, label) AS (VALUES @contracts@),
lowered AS (
  SELECT * REPLACE (lower(from_address) AS from_address, lower(to_address) AS to_address)
  FROM judged WHERE reject_reason IS NULL),
norm AS (
  SELECT n.*, c.label, CASE WHEN n.type = 'EVENT_TYPE_TRANSACTION' AND to_address <> ''
    THEN CASE WHEN c.address IS NULL THEN 'transfer' ELSE 'contract_call' END END AS kind
  FROM lowered n LEFT JOIN contracts c ON n.to_address = c.address)
""".replace("@contracts@", ", ".join(f"('{a}', '{name}')" for a, name in S.KNOWN_CONTRACTS.items()))

ATTRIBUTES = """
'{' || CASE WHEN label IS NULL THEN '' ELSE '"contract_label":"' || label || '",' END
    || '"k":"' || k || '"'
    || CASE WHEN kind IS NULL THEN '' ELSE ',"tx_kind":"' || kind || '"' END || '}'
"""

REDELIVERED = """
twice AS (
  SELECT * FROM judged WHERE reject_reason IS NULL
  UNION ALL
  SELECT * REPLACE (observed_at + INTERVAL 5 SECOND AS observed_at)
  FROM judged WHERE reject_reason IS NULL AND e % 17 = 0)
"""

SEQUENCED = """
ev AS (
  SELECT *, date_trunc('hour', block_time) + INTERVAL 1 HOUR AS we,
    row_number() OVER arrival AS seq,
    max(block_time) OVER (arrival ROWS UNBOUNDED PRECEDING) AS watermark
  FROM norm WINDOW arrival AS (PARTITION BY chain ORDER BY observed_at, id)),
steps AS (SELECT chain, watermark, min(seq) AS seq FROM ev GROUP BY chain, watermark),
opened AS (
  SELECT chain, we, min(seq) AS seq, we + INTERVAL 30 MINUTE AS due FROM ev GROUP BY chain, we),
closes AS (
  SELECT o.chain, o.we, greatest(o.seq, s.seq) AS seq
  FROM opened o ASOF JOIN steps s ON o.chain = s.chain AND o.due <= s.watermark),
marks AS (
  SELECT chain, seq, max(max(we)) OVER (PARTITION BY chain ORDER BY seq) AS closed_up_to
  FROM closes GROUP BY chain, seq),
flagged AS (
  SELECT ev.*, coalesce(ev.we <= m.closed_up_to, false) AS is_late
  FROM ev ASOF LEFT JOIN marks m ON ev.chain = m.chain AND ev.seq > m.seq),
accepted AS (SELECT * FROM flagged WHERE NOT is_late)
"""


def _rows(source: str, size: str = "INTERVAL 1 HOUR", where: str = "") -> str:
    """Aggregate rows of a relation with ``chain`` and window end ``we``."""
    total = (
        "sum(CASE WHEN regexp_full_match(value_wei, '[+-]?[0-9]+')"
        " THEN TRY_CAST(value_wei AS DECIMAL(38,0)) ELSE 0 END)"
    )
    metrics = [
        (S.METRIC_EVENTS, "count(*)"),
        (S.METRIC_GAS, "sum(gas_used)"),
        (S.METRIC_WEI, total),
        (S.METRIC_ADDRESSES, "count(DISTINCT nullif(from_address, ''))"),
    ]
    parts = [
        f"SELECT chain, '{name}' AS metric, we, '' AS labels_key,"
        f" CAST({value} AS VARCHAR) AS value_exact FROM {source} {where} GROUP BY chain, we"
        for name, value in metrics
    ]
    parts.append(
        f"SELECT chain, '{S.METRIC_EVENTS}', we, 'type=' || type, CAST(count(*) AS VARCHAR)"
        f" FROM {source} {where} GROUP BY chain, we, type"
    )
    return (
        f"SELECT chain, metric, we - {size} AS window_start, we AS window_end, labels_key,"
        " CASE labels_key WHEN '' THEN '{}'"
        " ELSE '{\"type\":\"' || substr(labels_key, 6) || '\"}' END AS labels,"
        " CAST(value_exact AS DOUBLE) AS value, value_exact"
        f" FROM ({' UNION ALL '.join(parts)})"
    )


CLOSED_ONLY = (
    "WHERE EXISTS (SELECT 1 FROM closes c WHERE c.chain = accepted.chain AND c.we = accepted.we)"
)
CLOSED_ROWS = f"agg AS ({_rows('accepted', where=CLOSED_ONLY)})"
FLUSH_ROWS = f"agg AS ({_rows('accepted')})"
SHOW = (
    f"chain, metric, {_at('window_start')}, {_at('window_end')}, labels_key, labels,"
    " value, value_exact"
)


def _with(*ctes: str, select: str) -> str:
    return f"WITH {', '.join((FEED, *ctes))} {select}"


def _rate(source: str, step: str, keys: str, count: str, seconds: int, stamp: str) -> str:
    groups = ", ".join(filter(None, [keys, "b"]))
    return (
        f"SELECT {keys}{', ' if keys else ''}{_at('b', 'bucket')}, n AS {count},"
        f" n / {float(seconds)} AS per_second FROM (SELECT {keys}{', ' if keys else ''}"
        f"time_bucket(INTERVAL {step}, {stamp}) AS b, count(*) AS n"
        f" FROM {source} GROUP BY {groups})"
    )


def _quantiles() -> str:
    bounds = Q.FRESHNESS_BOUNDS
    counts = ", ".join(
        f"count(*) FILTER (WHERE latency <= {b}) AS le_{i}" for i, b in enumerate(bounds)
    )

    def quantile(q: float) -> str:
        arms = []
        for i, upper in enumerate(bounds):
            lower, before = (bounds[i - 1], f"le_{i - 1}") if i else (0.0, "0")
            arms.append(
                f"WHEN le_{i} >= events * {q}::DOUBLE THEN {lower}::DOUBLE + {upper - lower}::DOUBLE"
                f" * (events * {q}::DOUBLE - {before}) / (le_{i} - {before})"
            )
        return f"CASE {' '.join(arms)} ELSE {bounds[-1]}::DOUBLE END AS p{round(q * 100)}"

    return _with(
        "delays AS (SELECT chain, type, epoch_us(observed_at) / 1e6 - epoch_us(block_time) / 1e6"
        " AS latency FROM norm)",
        f"hist AS (SELECT chain, type, {counts}, count(*) AS events FROM delays GROUP BY ALL)",
        select=f"SELECT chain, type, events, events - le_{len(bounds) - 1} AS above, "
        + ", ".join(quantile(q) for q in (0.5, 0.95, 0.99))
        + " FROM hist",
    )


def _exact_quantiles() -> str:
    cuts = ", ".join(
        f"round(quantile_cont(latency, {q}), 6) AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99)
    )
    return _with(
        "delays AS (SELECT chain, type, epoch_us(observed_at) / 1e6 - epoch_us(block_time) / 1e6"
        " AS latency FROM norm)",
        select=f"SELECT chain, type, count(*) AS events, {cuts} FROM delays GROUP BY chain, type",
    )


def _lag_ctes() -> tuple[str, ...]:
    marks = [("end_offset", 0), *Q.GROUP_DELAY_S.items()]
    day = "floor((epoch(observed_at) + {}) / 86400)::BIGINT"
    flat = " UNION ALL ".join(
        f"SELECT e % {Q.PARTITIONS} AS p, '{k}' AS mark, {day.format(d)} AS day FROM feed"
        for k, d in marks
    )
    groups = " UNION ALL ".join(
        f"SELECT 'run-{g}' AS label, '{g}' AS grp, day, p, end_offset, {g} AS committed FROM sofar"
        for g in Q.GROUP_DELAY_S
    )
    so_far = ", ".join(
        f"(SELECT count(*) FROM flat f WHERE f.mark = '{k}' AND f.p = s.p AND f.day <= s.day) AS {k}"
        for k, _ in marks
    )
    return (
        f"flat AS ({flat})",
        "spine AS (SELECT p, unnest(range(lo, hi + 1)) AS day, lo FROM"
        f" (SELECT min(day) AS lo, max(day) AS hi FROM flat), range({Q.PARTITIONS}) r(p))",
        f"sofar AS (SELECT p, day - lo AS day, {so_far} FROM spine s)",
        f"snaps AS ({groups})",
        'lags AS (SELECT label, day * 86400.0::DOUBLE AS elapsed_s, grp AS "group",'
        " sum(end_offset - committed)::BIGINT AS records_lag,"
        " sum(committed)::BIGINT AS committed, sum(end_offset)::BIGINT AS end_offset"
        " FROM snaps GROUP BY ALL)",
    )


def _decoded(with_bodies: bool) -> str:
    columns = (
        "id, type, block_number, block_hash, tx_hash, from_address, to_address, value_wei,"
        f" {_at('t + INTERVAL 2 SECOND', 'observed_at')},"
        f" {_at('CASE WHEN undated THEN t + INTERVAL 2 SECOND ELSE t END', 'block_time')}"
    )
    parts = [
        "SELECT 'evt:ethereum:' || block_hash AS id, 'EVENT_TYPE_BLOCK' AS type, block_number,"
        " block_hash, '' AS tx_hash, '' AS from_address, '' AS to_address, '' AS value_wei, t,"
        " undated FROM blocks"
    ]
    if with_bodies:
        parts.append(
            "SELECT 'evt:ethereum:' || tx_hash, 'EVENT_TYPE_TRANSACTION', b.block_number,"
            " b.block_hash, tx_hash, from_address, to_address,"
            " CASE WHEN value_wei = 'not-a-number' THEN '0' ELSE"
            " CAST(left(value_wei, -14)::HUGEINT * 281474976710656::HUGEINT AS VARCHAR) END, b.t,"
            " b.undated FROM feed d JOIN blocks b ON d.block_number = b.block_number"
            " WHERE type = 'EVENT_TYPE_TRANSACTION' AND tx_hash <> ''"
        )
    return _with(
        "blocks AS (SELECT block_number, block_hash,"
        " date_trunc('second', coalesce(min(block_time), min(observed_at))) AS t,"
        " count(*) > count(block_time) AS undated FROM feed GROUP BY ALL)",
        select=f"SELECT {columns} FROM ({' UNION ALL '.join(parts)})",
    )


def _json_object(*pairs: tuple[str, str, bool]) -> str:
    """JSON text with keys in the given order; the flag marks quoted values."""
    fields = [
        f"'\"{key}\":{mark}' || {value} || '{mark}'"
        for key, value, quoted in pairs
        for mark in ('"' if quoted else "",)
    ]
    return "'{' || " + " || ',' || ".join(fields) + " || '}'"


def _hex_number(text: str, digits: int) -> str:
    """Value of ``digits`` lower-case hex characters as UHUGEINT."""
    terms = [
        f"(instr('0123456789abcdef', substr({text}, {i + 1}, 1)) - 1)::UHUGEINT"
        f" * {16 ** (digits - 1 - i)}::UHUGEINT"
        for i in range(digits)
    ]
    return "(" + " + ".join(terms) + ")"


def _hex_quantities() -> str:
    digest = "substr(block_hash, 3)"
    return _with(
        f"blocks AS (SELECT block_hash, {_hex_number(digest, 16)} AS u64,"
        f" {_hex_number(digest, 30)} AS u120, {_hex_number(digest, 32)} AS u128,"
        f" {_hex_number(digest, 8)} AS secs FROM (SELECT DISTINCT block_hash FROM feed))",
        select="SELECT e AS event_id, u64::VARCHAR AS u64, true AS too_wide, u120::VARCHAR AS u120,"
        f" u128::VARCHAR AS u128, strftime(to_timestamp(secs::BIGINT) AT TIME ZONE 'UTC', {_STAMP})"
        " AS at FROM feed JOIN blocks USING (block_hash)",
    )


def oracle_sql() -> dict[str, str]:
    since, until = Q.RANGE
    f = Q.FILTER
    types = ", ".join(f"'{t}'" for t in f["types"])
    first = "SELECT *, row_number() OVER (PARTITION BY id ORDER BY observed_at) AS rn FROM twice"
    attrs = f"SELECT id, chain, type, block_number, tx_hash, from_address, to_address,{ATTRIBUTES} AS attributes FROM norm"
    show_agg = f"SELECT {SHOW} FROM agg"
    labels_key = (
        "CASE WHEN label IS NULL THEN '' ELSE 'contract_label=' || label || ',' END || 'k=' || k"
        " || CASE WHEN kind IS NULL THEN '' ELSE ',tx_kind=' || kind END"
    )
    closed = (SEQUENCED, CLOSED_ROWS)
    flushed = (SEQUENCED, FLUSH_ROWS)
    batch = "hourly AS (SELECT *, date_trunc('hour', block_time) + INTERVAL 1 HOUR AS we FROM norm)"
    weekly = (
        "weekly AS (SELECT *, time_bucket(INTERVAL 7 DAY, block_time, TIMESTAMP '0001-01-01')"
        " + INTERVAL 7 DAY AS we FROM norm)"
    )
    return {
        "validate_rejects_by_reason": _with(
            select="SELECT reject_reason, count(*) AS events FROM judged"
            " WHERE reject_reason IS NOT NULL GROUP BY 1"
        ),
        "reject_rate": _with(
            "bad AS (SELECT * FROM judged WHERE reject_reason IS NOT NULL)",
            select=_rate("bad", "5 MINUTE", "reject_reason", "events", 300, "observed_at"),
        ),
        "normalized_events": _with(select=attrs),
        "contract_activity": _with(
            select="SELECT type, coalesce(label, '') AS contract_label,"
            " coalesce(kind, '') AS tx_kind, count(*) AS events FROM norm GROUP BY ALL"
        ),
        "contract_activity_shuffled": _with(
            select="SELECT type, coalesce(label, '') AS contract_label,"
            " coalesce(kind, '') AS tx_kind, count(*) AS events FROM norm GROUP BY ALL"
        ),
        "filtered_events": _with(
            select="SELECT id, chain, type, from_address, to_address FROM norm"
            f" WHERE lower(chain) = lower('{f['chain']}') AND type IN ({types})"
            f" AND lower('{f['address']}') IN (from_address, to_address)"
        ),
        "filtered_stored_events": _with(
            select="SELECT id, chain, type, from_address, to_address FROM norm"
            f" WHERE lower(chain) = lower('{f['chain']}') AND type IN ({types})"
            f" AND lower('{f['address']}') IN (from_address, to_address)"
        ),
        "partition_key_counts": _with(
            select="SELECT CASE WHEN from_address <> '' THEN from_address"
            " WHEN block_hash <> '' THEN block_hash ELSE chain END AS key,"
            " count(*) AS events FROM feed GROUP BY 1"
        ),
        "labels_forms": _with(
            select=f"SELECT {labels_key} AS labels_key, {ATTRIBUTES} AS labels,"
            " count(*) AS events FROM norm GROUP BY ALL"
        ),
        "dedup_first_seen": _with(
            REDELIVERED,
            select=f"SELECT id, chain, type, block_number, {_at('observed_at')}"
            f" FROM ({first}) WHERE rn = 1",
        ),
        "dedup_dropped_per_minute": _with(
            REDELIVERED,
            select=f"SELECT {_at('b', 'bucket')}, dropped FROM (SELECT"
            " date_trunc('minute', observed_at) AS b, count(*) AS dropped"
            f" FROM ({first}) WHERE rn > 1 GROUP BY 1)",
        ),
        "window_events_by_type": _with(
            batch,
            select=f"SELECT chain, {_at('we - INTERVAL 1 HOUR', 'window_start')},"
            " coalesce(type, '') AS type, count(*) AS events FROM hourly"
            " GROUP BY GROUPING SETS ((chain, we, type), (chain, we))",
        ),
        "window_metrics_long": _with(batch, f"agg AS ({_rows('hourly')})", select=show_agg),
        "window_metrics_weekly": _with(
            weekly, f"agg AS ({_rows('weekly', 'INTERVAL 7 DAY')})", select=show_agg
        ),
        "replay_late_flags": _with(SEQUENCED, select="SELECT id, chain, is_late FROM flagged"),
        "replay_late_flags_partitioned": _with(
            SEQUENCED, select="SELECT id, chain, is_late FROM flagged"
        ),
        "replay_late_flags_by_position": _with(
            SEQUENCED, select="SELECT id, chain, is_late FROM flagged"
        ),
        "replay_closed_metrics": _with(*closed, select=show_agg),
        "replay_flush_metrics": _with(*flushed, select=show_agg),
        "upsert_latest": _with(
            *flushed,
            batch,
            f"plain AS ({_rows('hourly')})",
            select=f"SELECT {SHOW} FROM (SELECT * FROM agg UNION ALL SELECT p.* FROM plain p"
            " ANTI JOIN agg USING (chain, metric, window_start, labels_key))",
        ),
        "aggregates_range": _with(
            *flushed,
            select=f"SELECT chain, metric, {_at('window_start')}, labels,"
            " labels = '{}' AS no_labels, value FROM (SELECT * FROM agg WHERE chain = 'ethereum'"
            f" AND metric = '{S.METRIC_EVENTS}' AND window_start >= TIMESTAMP '{since}'"
            f" AND window_start < TIMESTAMP '{until}'"
            f" ORDER BY agg.window_start, metric, chain, labels_key LIMIT {S.MAX_QUERY_ROWS})",
        ),
        "aggregates_pages": _with(
            *flushed,
            select=f"SELECT chain, metric, {_at('window_start')}, labels_key, value FROM agg",
        ),
        "recent_rows": _with(
            *flushed,
            select="SELECT chain, CASE labels_key WHEN '' THEN metric"
            " ELSE metric || ' (' || substr(labels_key, 6) || ')' END AS title,"
            f" {_at('window_start')}, value FROM (SELECT * FROM agg"
            f" WHERE metric = '{S.METRIC_EVENTS}' ORDER BY agg.window_start DESC, metric DESC,"
            f" chain DESC, labels_key DESC LIMIT {S.RECENT_ROWS})",
        ),
        "pipeline_totals": _with(
            *closed,
            "last AS (SELECT date_trunc('second', max(observed_at)) AS t FROM feed)",
            select="SELECT (SELECT count(*) FROM feed) AS events_ingested,"
            " (SELECT count(*) FROM norm) AS events_normalized,"
            " (SELECT count(*) FROM agg) AS aggregates_emitted,"
            " (SELECT count(*) / 60.0 FROM feed, last"
            " WHERE date_trunc('second', observed_at) > t - INTERVAL 60 SECOND) AS events_per_second,"
            f" (SELECT strftime(min(observed_at), {_STAMP}) FROM feed) AS since",
        ),
        "ingest_rate": _with(
            select=_rate("feed", "1 MINUTE", "chain, type", "events", 60, "observed_at")
        ),
        "funnel_per_minute": _with(
            select=f"SELECT {_at('b', 'bucket')}, ingested, normalized FROM (SELECT"
            " date_trunc('minute', observed_at) AS b, count(*) AS ingested,"
            " count(*) FILTER (WHERE reject_reason IS NULL) AS normalized FROM judged GROUP BY 1)"
        ),
        "rows_by_metric": _with(
            *closed,
            select="SELECT metric, count(*) AS aggregates_emitted,"
            " count(DISTINCT (chain, window_start)) AS windows_closed FROM agg GROUP BY 1",
        ),
        "emission_rate": _with(
            *closed,
            select=_rate("agg", "5 MINUTE", "metric", "aggregates_emitted", 300, "window_end"),
        ),
        "late_per_chain": _with(
            SEQUENCED,
            select="SELECT chain, count(*) FILTER (WHERE is_late) AS late,"
            " count(*) FILTER (WHERE NOT is_late) AS accepted FROM flagged GROUP BY 1",
        ),
        "late_rate": _with(
            SEQUENCED,
            "late AS (SELECT * FROM flagged WHERE is_late)",
            select=_rate("late", "5 MINUTE", "chain", "late", 300, "observed_at"),
        ),
        "freshness_quantiles": _exact_quantiles(),
        "freshness_histogram": _quantiles(),
        "group_lag": _with(*_lag_ctes(), select="SELECT * FROM lags"),
        "group_lag_scanned": _with(*_lag_ctes(), select="SELECT * FROM lags"),
        "peak_lag": _with(
            *_lag_ctes(), select="SELECT label, max(records_lag) AS peak_lag FROM lags GROUP BY 1"
        ),
        "lag_csv": _with(
            *_lag_ctes(),
            select="SELECT label, printf('%.1f', elapsed_s) AS elapsed_s, \"group\","
            " records_lag::VARCHAR AS records_lag, committed::VARCHAR AS committed,"
            " end_offset::VARCHAR AS end_offset FROM lags",
        ),
        "decode_chain_blocks": _decoded(True),
        "decode_heads_only": _decoded(False),
        "stream_decode_blocks": _decoded(True),
        "hex_quantities": _hex_quantities(),
        "decode_json_records": _with(
            select="SELECT reject_reason, count(*) AS events,"
            " sum(CASE WHEN broken THEN NULL ELSE gas_used END)::VARCHAR AS gas_used,"
            " count(CASE WHEN broken THEN NULL ELSE block_time END) AS with_block_time"
            " FROM (SELECT * REPLACE (CASE WHEN e % 97 = 0 THEN 'undecodable'"
            " ELSE coalesce(reject_reason, '') END AS reject_reason), e % 97 = 0 AS broken"
            " FROM judged) GROUP BY 1"
        ),
        "ndjson_export": _with(
            select="SELECT "
            + _json_object(
                ("id", "id", True),
                ("chain", "chain", True),
                ("type", "type", True),
                ("block_number", "block_number", False),
                ("from_address", "from_address", True),
                ("to_address", "to_address", True),
                ("value_wei", "value_wei", True),
                ("gas_used", "gas_used", False),
                ("block_time", f"strftime(block_time, {_STAMP})", True),
            )
            + " AS value FROM norm"
        ),
        "keyed_aggregate_records": _with(
            *closed,
            select="SELECT chain AS key, "
            + _json_object(
                ("chain", "chain", True),
                ("metric", "metric", True),
                ("window_start", f"strftime(window_start, {_STAMP})", True),
                ("labels_key", "labels_key", True),
                ("value_exact", "value_exact", True),
            )
            + " AS value FROM agg",
        ),
        "stream_exact_metrics": _with(*closed, select=show_agg),
        "stream_exact_many_batches": _with(*closed, select=show_agg),
        "stream_exact_late_counts": _with(
            SEQUENCED,
            select="SELECT chain, count(*) FILTER (WHERE is_late) AS late,"
            " count(*) FILTER (WHERE NOT is_late) AS accepted FROM flagged GROUP BY 1",
        ),
        "stream_exact_flush": _with(*flushed, select=show_agg),
        "stream_native_metrics": _with(
            batch,
            "passed AS (SELECT * FROM hourly WHERE we <="
            " (SELECT max(block_time) - INTERVAL 30 MINUTE FROM norm))",
            f"agg AS ({_rows('passed')})",
            select=show_agg,
        ),
        "stream_normalized": _with(
            select=f"SELECT id, chain, type, from_address, to_address,{ATTRIBUTES} AS attributes"
            " FROM norm"
        ),
        "stream_deduplicated": _with(
            "twice AS (SELECT reject_reason FROM judged"
            " UNION ALL SELECT reject_reason FROM judged WHERE e % 17 = 0)",
            select="SELECT received, rejected, kept, received - rejected - kept AS suppressed,"
            " kept AS ids FROM (SELECT count(*) AS received, count(reject_reason) AS rejected FROM twice),"
            " (SELECT count(*) AS kept FROM norm)",
        ),
        "stream_rejects": _with(
            select="SELECT coalesce(reject_reason, '') AS reject_reason, count(*) AS events"
            " FROM judged GROUP BY 1"
        ),
        "stream_keyed_events": _with(
            select="SELECT CASE WHEN from_address <> '' THEN from_address"
            " WHEN block_hash <> '' THEN block_hash ELSE chain END AS key,"
            " count(*) AS events FROM feed GROUP BY 1"
        ),
        "stream_tail": _with(
            select=f"SELECT id, from_address, {_at('observed_at')} FROM norm"
            f" WHERE observed_at >= TIMESTAMP '{Q.TAIL_START}' AND lower(chain) = 'solana'"
            f" AND type = '{S.TYPE_TRANSACTION}'"
        ),
    }
