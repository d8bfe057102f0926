"""Common table expressions of the reference SQL.

They restate the fixtures in plain SQL, with windows and self-joins where the Spark jobs
use other means, so that agreement says something.
"""

from __future__ import annotations


def _json(amount: str, order_id: str) -> str:
    return f"""concat('{{', concat_ws(',',
        {order_id},
        '"customerId":"cust-' || user_id || '"',
        '"amountCents":' || {amount},
        CASE WHEN ingest_seq % 20 <> 4 THEN '"currency":"USD"' END,
        '"itemCount":' || (1 + ingest_seq % 5),
        '"producedAt":' || (epoch_us(appended_at) // 1000),
        CASE WHEN appended_at >= TIMESTAMP '2024-01-16 00:00:00'
             THEN '"schemaVersion":"v2"' ELSE '"schemaVersion":"v1"' END,
        CASE WHEN appended_at >= TIMESTAMP '2024-01-16 00:00:00' AND ingest_seq % 2 = 0
             THEN '"promoCode":"SAVE10"' END), '}}')"""


_ID = """'"orderId":"ord-' || biz || '"'"""
_CENTS = "CAST(round(value * 100) AS BIGINT)"

PARTS = {
    "base": """
        SELECT event_id AS ingest_seq, ts AS appended_at, user_id, value,
               CASE WHEN event_id % 10 = 7 THEN event_id - 3 ELSE event_id END AS biz
        FROM events""",
    "feed": f"""
        SELECT ingest_seq, 'orders' AS topic, CAST(biz % 12 AS INTEGER) AS record_partition,
               CAST(nth + nth // 100 AS BIGINT) AS record_offset,
               CASE WHEN ingest_seq % 200 <> 163 THEN 'ord-' || biz END AS record_key,
               appended_at, CAST(round(value * 10) AS BIGINT) AS latency_ms,
               CASE WHEN ingest_seq % 100 = 51 THEN NULL
                    WHEN ingest_seq % 100 = 13 THEN 'THIS-IS-NOT-AVRO'
                    WHEN ingest_seq % 100 = 63 THEN '{{"orderId":"ord-' || biz
                    WHEN ingest_seq % 200 = 91 THEN ''
                    WHEN ingest_seq % 200 = 29 THEN {_json("'" + '"abc"' + "'", _ID)}
                    WHEN ingest_seq % 200 = 129 THEN {_json(_CENTS, "NULL")}
                    WHEN ingest_seq % 400 = 171 THEN {_json(_CENTS, _ID)} || {_json(_CENTS, _ID)}
                    WHEN ingest_seq % 400 = 371 THEN {_json(_CENTS, _ID)} || 'XYZ'
                    WHEN ingest_seq % 400 = 271 THEN {_json(_CENTS, "'" + '"orderId":""' + "'")}
                    ELSE {_json(_CENTS, _ID)} END AS payload
        FROM (SELECT *, row_number() OVER (PARTITION BY biz % 12 ORDER BY ingest_seq) - 1 AS nth
              FROM base)""",
    "opened": """
        SELECT *, CASE WHEN json_valid(payload) THEN payload END AS doc FROM feed""",
    "fields": """
        SELECT * EXCLUDE doc,
               payload IS NOT NULL AND payload <> '' AND (doc IS NULL
                   OR try_cast(doc->>'$.amountCents' AS BIGINT) IS NULL) AS malformed,
               doc->>'$.orderId' AS f_id, doc->>'$.customerId' AS f_customer,
               try_cast(doc->>'$.amountCents' AS BIGINT) AS f_cents,
               doc->>'$.currency' AS f_currency,
               try_cast(doc->>'$.itemCount' AS INTEGER) AS f_items,
               try_cast(doc->>'$.producedAt' AS BIGINT) AS f_produced,
               doc->>'$.schemaVersion' AS f_version, doc->>'$.promoCode' AS f_promo
        FROM opened""",
    "judged": """
        SELECT *, CASE WHEN payload IS NULL THEN NULL
                       WHEN payload = '' THEN 'empty payload'
                       WHEN malformed THEN 'malformed payload'
                       WHEN f_id IS NULL OR f_id = '' THEN 'missing required field: orderId' END AS reason
        FROM fields""",
    "decoded": """
        SELECT *, CASE WHEN payload IS NULL THEN 'tombstone'
                       WHEN reason IS NOT NULL THEN 'poison' ELSE 'order' END AS kind,
               CASE WHEN payload IS NOT NULL AND reason IS NULL THEN f_id END AS order_id
        FROM judged""",
    "orders_in": """
        SELECT ingest_seq, topic, record_partition, record_offset, appended_at, latency_ms,
               order_id, f_customer AS customer_id, f_cents AS amount_cents,
               coalesce(f_currency, 'USD') AS currency, f_currency IS NULL AS currency_defaulted,
               f_items AS item_count, f_produced AS produced_at,
               coalesce(f_version, 'v2') AS schema_version, f_promo AS promo_code
        FROM decoded WHERE kind = 'order'""",
    "firsts": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_seq) AS nth,
                   count(*) OVER (PARTITION BY order_id) AS copies
            FROM orders_in) WHERE nth = 1""",
    "minutes": """
        SELECT CAST(date_trunc('minute', make_timestamp(produced_at * 1000)) AS TIMESTAMP)
                   AS minute,
               count(*) AS order_count, CAST(sum(amount_cents) AS BIGINT) AS total_cents
        FROM firsts GROUP BY 1""",
    "quarantine": """
        SELECT ingest_seq AS id, topic AS source_topic, record_partition AS source_partition,
               record_offset AS source_offset,
               CAST(abs(record_partition % 3) AS INTEGER) AS dlq_partition,
               record_key AS key_hint,
               left('Deserialization failed: ' || reason, 2000) AS exception_message,
               to_base64(encode(payload)) AS raw_base64, appended_at AS received_at,
               ingest_seq % 400 < 200 AS replayed
        FROM decoded WHERE kind = 'poison'""",
    # Metric samples; tick is whole seconds on the hourly grid.
    "grid": """
        SELECT unnest(range(lo, hi + 3600, 3600)) AS t FROM (
            SELECT (epoch_us(min(ts)) + 3599999999) // 3600000000 * 3600 AS lo,
                   CAST(epoch(date_trunc('hour', max(ts))) AS BIGINT) AS hi FROM events)""",
    "consumed": """
        SELECT g.t, s.series,
               (SELECT count(*) FROM events e
                WHERE CAST(e.event_id % 12 AS INTEGER) = s.series AND epoch_us(e.ts) <= g.t * 1000000
                  AND (epoch_us(e.ts) >= 1705276800000000) = (g.t >= 1705276800)) AS v
        FROM grid g, (SELECT CAST(unnest(range(12)) AS INTEGER) AS series) s""",
    "dead": """
        SELECT g.t, (SELECT count(*) FROM decoded d
                     WHERE d.kind = 'poison' AND epoch_us(d.appended_at) <= g.t * 1000000) AS v
        FROM grid g""",
    "bounds": """
        SELECT unnest([0.1, 0.25, 0.5, 1, 2, 5, 'Infinity'::DOUBLE]::DOUBLE[]) AS le""",
    "buckets": """
        SELECT g.t, s.series, b.le,
               (SELECT count(*) FROM firsts f
                WHERE CAST(f.ingest_seq % 3 AS INTEGER) = s.series
                  AND epoch_us(f.appended_at) <= g.t * 1000000 AND f.latency_ms / 1000.0 <= b.le) AS v
        FROM grid g, (SELECT CAST(unnest(range(3)) AS INTEGER) AS series) s, bounds b""",
    "lag_ends": """
        SELECT g.t, s.series,
               (SELECT count(*) FROM feed f
                WHERE f.record_partition = s.series AND epoch_us(f.appended_at) <= g.t * 1000000) AS v
        FROM grid g, (SELECT CAST(unnest(range(12)) AS INTEGER) AS series) s""",
    "lag": """
        SELECT e.t, e.series, greatest(0, e.v - coalesce(c.v, 0)) AS v
        FROM lag_ends e LEFT JOIN lag_ends c ON c.series = e.series
             AND c.t = CASE WHEN e.t >= 1704844800 AND e.t < 1705017600 THEN 1704844800
                            ELSE e.t END - 21600""",
}

_NEEDS = {
    "feed": ["base"],
    "opened": ["feed"],
    "fields": ["opened"],
    "judged": ["fields"],
    "decoded": ["judged"],
    "orders_in": ["decoded"],
    "firsts": ["orders_in"],
    "minutes": ["firsts"],
    "quarantine": ["decoded"],
    "consumed": ["grid"],
    "dead": ["grid", "decoded"],
    "buckets": ["grid", "bounds", "firsts"],
    "lag_ends": ["grid", "feed"],
    "lag": ["lag_ends"],
}


def select(sql: str, *parts: str, **extra: str) -> str:
    """``sql`` behind the parts it names, each after those it needs."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for part in parts:
        need(part)
    ctes = [f"{n} AS MATERIALIZED ({PARTS[n]})" for n in order]
    ctes += [f"{n} AS MATERIALIZED ({body})" for n, body in extra.items()]
    return f"WITH {', '.join(ctes)} {sql}" if ctes else sql


def growth_parts(samples: str, keys: list[str], range_s: int) -> dict[str, str]:
    """Growth over a closed range by a range self-join of the samples."""
    cols = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    same = "".join(f"s.{k} = g.{k} AND " for k in keys)
    spine = f"SELECT DISTINCT {cols}t AS tick FROM {samples}"
    return {
        "linked": f"""SELECT *, lag(v) OVER ({part} ORDER BY t) AS before FROM {samples}""",
        "spine": spine,
        "inrange": f"""
            SELECT {''.join(f'g.{k}, ' for k in keys)}g.tick, s.t, s.v,
                   CASE WHEN s.v < s.before THEN s.before ELSE 0 END AS lost,
                   row_number() OVER (PARTITION BY {''.join(f'g.{k}, ' for k in keys)}g.tick
                                      ORDER BY s.t) AS nth
            FROM spine g JOIN linked s ON {same}s.t BETWEEN g.tick - {range_s} AND g.tick""",
        "summed": f"""
            SELECT {cols}tick, count(*) AS n, min(t) AS t0, max(t) AS t1, arg_min(v, t) AS v0,
                   CAST(arg_max(v, t) - arg_min(v, t)
                        + coalesce(sum(lost) FILTER (nth > 1), 0) AS BIGINT) AS growth
            FROM inrange GROUP BY {cols}tick HAVING max(t) > min(t)""",
        "edges": f"""
            SELECT *, CAST(t1 - t0 AS DOUBLE) AS covered,
                   CAST(t1 - t0 AS DOUBLE) / (n - 1) AS gap,
                   CAST(t0 - (tick - {range_s}) AS DOUBLE) AS head,
                   CAST(tick - t1 AS DOUBLE) AS tail FROM summed""",
        "grown": f"""
            SELECT {cols}tick, growth, growth * (covered
                   + least(CASE WHEN head >= gap * 1.1 THEN gap / 2 ELSE head END,
                           CASE WHEN growth <> 0 THEN covered * v0 / growth END)
                   + CASE WHEN tail >= gap * 1.1 THEN gap / 2 ELSE tail END) / covered AS increase
            FROM edges""",
    }


def fine_parts(
    step_s: int, source: str, condition: str, keys: dict[str, str], named: dict[str, str] | None = None
) -> dict[str, str]:
    """Samples of a counter on a fine grid: counts per tick, run up by one window a series."""
    micros = step_s * 1_000_000
    cols = "".join(f"{k}, " for k in keys)
    read = "".join(f"{(named or {}).get(k, k)} AS {k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return {
        "fine": f"""
            SELECT unnest(range(lo, hi + 1, {step_s})) AS t FROM (
                SELECT (epoch_us(min(ts)) + {micros - 1}) // {micros} * {step_s} AS lo,
                       epoch_us(max(ts)) // 1000000 AS hi FROM events)""",
        "ticked": f"""
            SELECT {cols}t, count(*) AS n FROM (
                SELECT {read}(epoch_us(appended_at) + {micros - 1}) // {micros} * {step_s} AS t
                FROM {source} WHERE {condition}) GROUP BY ALL""",
        "samples": f"""
            SELECT {cols}t, CAST(sum(coalesce(n, 0)) OVER ({part} ORDER BY t) AS BIGINT) AS v
            FROM fine {''.join(f'CROSS JOIN ({body}) ' for body in keys.values())}
            LEFT JOIN ticked USING ({cols}t)""",
    }


def full_growth_parts(keys: list[str], range_s: int) -> dict[str, str]:
    """Growth of ``samples`` that have a value at every tick and never restart, by range windows."""
    cols = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return {
        "spans": f"""
            SELECT {cols}t AS tick, v - first_value(v) OVER w AS growth, first_value(v) OVER w AS v0,
                   CAST(t - min(t) OVER w AS DOUBLE) AS covered, count(*) OVER w AS n
            FROM samples
            WINDOW w AS ({part}ORDER BY t RANGE BETWEEN {range_s} PRECEDING AND CURRENT ROW)""",
        "grown": f"""
            SELECT {cols}tick, growth, growth * (covered + least(
                       CASE WHEN {range_s} - covered >= covered / (n - 1) * 1.1
                            THEN covered / (n - 1) / 2 ELSE {range_s} - covered END,
                       CASE WHEN growth <> 0 THEN covered * v0 / growth END)) / covered AS increase
            FROM spans WHERE covered > 0""",
    }


def quantile_parts(range_s: int, ranks: tuple[float, ...]) -> dict[str, str]:
    """Quantiles per tick from the latency buckets summed over instances."""
    return growth_parts("buckets", ["series", "le"], range_s) | ranked_parts(ranks)


def ranked_parts(ranks: tuple[float, ...]) -> dict[str, str]:
    """Quantiles per tick from the growth of the buckets."""
    return {
        "by_le": """
            SELECT tick, le, sum(increase) AS cum FROM grown GROUP BY tick, le""",
        "laid": """
            SELECT *, coalesce(lag(cum) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS low,
                   max(cum) OVER (PARTITION BY tick) AS total
            FROM by_le WINDOW w AS (PARTITION BY tick ORDER BY le)""",
        "ranked": f"""
            SELECT tick, q, le, low, below, cum, total, q * total AS rank
            FROM laid, (SELECT unnest({list(ranks)}::DOUBLE[]) AS q)""",
        "quants": """
            SELECT tick, q, arg_min(
                       CASE WHEN isinf(le) THEN low
                            ELSE low + (le - low) * ((rank - below) / nullif(cum - below, 0)) END, le)
                       FILTER (cum >= rank AND total > 0) AS value
            FROM ranked GROUP BY tick, q""",
    }


def stretch_parts(evaluations: str, condition: str, step_s: int) -> dict[str, str]:
    """Stretches of true ticks by gaps and islands over row numbers."""
    return {
        "true_ticks": f"SELECT * FROM {evaluations} WHERE {condition}",
        "islands": f"""
            SELECT *, tick - {step_s} * row_number() OVER (ORDER BY tick) AS island
            FROM true_ticks""",
        "stretches": """
            SELECT * EXCLUDE island, min(tick) OVER (PARTITION BY island) AS since FROM islands""",
    }
