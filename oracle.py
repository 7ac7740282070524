"""SQL that answers the registered queries independently, for DuckDB over the same Parquet tables."""

from __future__ import annotations

# Common table expressions that most queries share.
_SESSION = "user_id * 1000 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_PARTS = {
    "clicks": f"""
        SELECT {_SESSION} AS session_id, ts, event_id, {_ITEM} AS item_id, event_type AS category
        FROM events WHERE event_type IN ('click', 'view')""",
    "purchases": f"""
        SELECT {_SESSION} AS session_id, ts, event_id, {_ITEM} AS item_id,
               CAST(value AS DECIMAL(18,2)) AS price, CAST(1 AS BIGINT) AS quantity,
               CAST(value AS DECIMAL(18,2)) AS utility
        FROM events WHERE event_type = 'purchase'""",
    "lines": """
        SELECT l_orderkey AS session_id, l_shipdate AS ts, l_linenumber AS line, l_partkey AS item_id,
               l_extendedprice AS extended_price, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS BIGINT) AS DECIMAL(18,2)) AS utility,
               CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT) AS brand
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "total": "SELECT CAST(sum(utility) AS DECIMAL(18,2)) AS u FROM purchases",
    "items": """
        SELECT item_id, CAST(sum(utility) AS DECIMAL(18,2)) AS utility FROM purchases GROUP BY item_id""",
    "high_items": "SELECT item_id, utility FROM items WHERE utility >= 0.01 * (SELECT u FROM total)",
    "clicked": "SELECT DISTINCT session_id, item_id AS click_item FROM clicks",
    "bought": "SELECT DISTINCT session_id, item_id AS purchase_item FROM purchases",
    "cps": """
        SELECT click_item, purchase_item, count(*) AS cps
        FROM clicked JOIN bought USING (session_id) GROUP BY click_item, purchase_item""",
    "chance": """
        SELECT click_item, purchase_item, cps, cps / n AS probability
        FROM cps JOIN (SELECT click_item, count(*) AS n FROM clicked GROUP BY click_item) USING (click_item)""",
    "matrix": """
        SELECT click_item, purchase_item, cps * utility AS weight
        FROM cps JOIN high_items ON purchase_item = item_id WHERE cps * utility > 0""",
    "scores": """
        SELECT session_id, purchase_item AS item_id, sum(weight) AS score
        FROM clicked JOIN matrix USING (click_item) GROUP BY session_id, purchase_item""",
    "ranked": """
        SELECT session_id, item_id, score,
               row_number() OVER (PARTITION BY session_id ORDER BY score DESC, item_id) AS rank
        FROM scores""",
    "cut": "SELECT round(quantile_cont(CAST(price AS DOUBLE), 0.95), 4) AS q FROM purchases",
    "trimmed": "SELECT * FROM purchases WHERE CAST(price AS DOUBLE) < (SELECT q FROM cut)",
    "weights": """
        SELECT session_id, item_id, own, total
        FROM (SELECT session_id, item_id, sum(utility) AS own FROM purchases GROUP BY session_id, item_id)
        JOIN (SELECT session_id, sum(utility) AS total FROM purchases GROUP BY session_id) USING (session_id)""",
    "swu": "SELECT item_id, sum(total) AS swu FROM weights GROUP BY item_id",
    "shards": """
        SELECT item_id, shard, utility
        FROM (SELECT session_id % 4 AS shard, item_id, sum(total) AS swu, sum(own) AS utility
              FROM weights GROUP BY 1, 2)
        WHERE swu >= 0.003 * (SELECT u FROM total) AND utility >= 0.003 * (SELECT u FROM total)""",
    "typed": f"SELECT {_SESSION} AS session_id, ts, event_id, event_type AS item FROM events",
    "steps": """
        SELECT session_id, item,
               row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS pos
        FROM typed""",
    "tens": """
        SELECT session_id, CAST(item_id % 10 AS VARCHAR) AS item,
               row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS pos
        FROM clicks""",
    "states": """
        SELECT l_orderkey AS session_id, l_returnflag || l_linestatus AS item,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_shipdate, l_linenumber, l_partkey, l_extendedprice) AS pos
        FROM lineitem""",
    "spent": """
        SELECT session_id, item_id AS item, utility AS u,
               row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS pos
        FROM purchases""",
    "years": """
        SELECT session_id, year(ts) AS pos, brand AS item, sum(utility) AS u FROM lines GROUP BY 1, 2, 3""",
}

_NEEDS = {
    "total": ["purchases"],
    "items": ["purchases"],
    "high_items": ["items", "total"],
    "clicked": ["clicks"],
    "bought": ["purchases"],
    "cps": ["clicked", "bought"],
    "chance": ["cps"],
    "matrix": ["cps", "high_items"],
    "scores": ["clicked", "matrix"],
    "ranked": ["scores"],
    "cut": ["purchases"],
    "trimmed": ["cut"],
    "weights": ["purchases"],
    "swu": ["weights"],
    "shards": ["weights", "total"],
    "steps": ["typed"],
    "tens": ["clicks"],
    "spent": ["purchases"],
    "years": ["lines"],
}


# Two events of a session to a part.
_PARTED = "SELECT *, (row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) - 1) // 2 AS part FROM {}"


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(_NEEDS.get(name, []), seen)
            seen.append(name)
    return seen


def _sql(names: str, body: str, **more: str) -> str:
    parts = [f"{name} AS ({_PARTS[name]})" for name in _needed(names.split(), [])]
    parts += [f"{name} AS ({text})" for name, text in more.items()]
    return f"WITH {', '.join(parts)}\n{body}"


def _frequent(steps: str, support: float) -> str:
    """Frequent sequences of one to three items by joining a session with itself."""
    return _sql(
        steps,
        "SELECT sequence, freq FROM found WHERE freq >= (SELECT m FROM least)",
        least=f"SELECT ceil(CAST({support} AS DOUBLE) * count(DISTINCT session_id)) AS m FROM {steps}",
        held=f"""
            SELECT DISTINCT session_id, item AS sequence FROM {steps}
            UNION ALL
            SELECT DISTINCT a.session_id, a.item || '>' || b.item
            FROM {steps} a JOIN {steps} b ON a.session_id = b.session_id AND a.pos < b.pos
            UNION ALL
            SELECT DISTINCT a.session_id, a.item || '>' || b.item || '>' || c.item
            FROM {steps} a JOIN {steps} b ON a.session_id = b.session_id AND a.pos < b.pos
            JOIN {steps} c ON a.session_id = c.session_id AND b.pos < c.pos""",
        found="SELECT sequence, count(*) AS freq FROM held GROUP BY sequence",
    )


def _valuable(steps: str, share: str, lengths: range, itemsets: bool) -> str:
    """High-utility patterns: the best match per session, by joining a session with itself."""
    follows = [("a.pos < b.pos", "'>'")] + ([("a.pos = b.pos AND a.item < b.item", "'+'")] if itemsets else [])
    then = [("b.pos < c.pos", "'>'")] + ([("b.pos = c.pos AND b.item < c.item", "'+'")] if itemsets else [])
    one = f"SELECT a.session_id, CAST(a.item AS VARCHAR) AS pattern, a.u AS u FROM {steps} a"
    two = [
        f"""SELECT a.session_id, a.item || {s} || b.item AS pattern, a.u + b.u AS u
            FROM {steps} a JOIN {steps} b ON a.session_id = b.session_id AND {on}"""
        for on, s in follows
    ]
    three = [
        f"""SELECT a.session_id, a.item || {s} || b.item || {t} || c.item AS pattern, a.u + b.u + c.u AS u
            FROM {steps} a JOIN {steps} b ON a.session_id = b.session_id AND {on}
            JOIN {steps} c ON a.session_id = c.session_id AND {after}"""
        for on, s in follows
        for after, t in then
    ]
    matches = [text for n, texts in ((1, [one]), (2, two), (3, three)) if n in lengths for text in texts]
    return _sql(
        steps,
        f"""SELECT pattern, CAST(utility AS DOUBLE) AS utility FROM summed
            WHERE utility >= {share} * (SELECT CAST(sum(u) AS DECIMAL(18,2)) FROM {steps})""",
        matches=" UNION ALL ".join(matches),
        best="SELECT session_id, pattern, max(u) AS u FROM matches GROUP BY session_id, pattern",
        summed="SELECT pattern, CAST(sum(u) AS DECIMAL(18,2)) AS utility FROM best GROUP BY pattern",
    )


_TOP = "SELECT session_id, rank, item_id, CAST(score AS DOUBLE) AS score FROM {0} WHERE rank <= {1}"

ORACLE_SQL = {
    "load_clicks": f"""
        SELECT {_SESSION} AS session_id, date_trunc('millisecond', ts) AS ts, {_ITEM} AS item_id, event_type AS category
        FROM events WHERE event_type NOT IN ('signup', 'error')""",
    "load_purchases": _sql(
        "purchases",
        """SELECT session_id, date_trunc('millisecond', ts) AS ts, item_id, CAST(price AS DOUBLE) / 8 AS price, quantity,
                  CAST(CAST(CAST(price AS DOUBLE) / 8 AS DECIMAL(18,5)) * quantity AS DOUBLE) AS utility
           FROM (SELECT * REPLACE (event_id % 3 + 1 AS quantity) FROM purchases)""",
    ),
    "category_kinds": _sql(
        "clicks",
        """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'offer' WHEN 1 THEN 'missing' WHEN 3 THEN 'category'
                  WHEN 2 THEN CASE WHEN item_id = 0 THEN 'missing' WHEN item_id BETWEEN 1 AND 12 THEN 'category' ELSE 'brand' END
                  END AS kind
           FROM clicks""",
    ),
    "drop_incomplete": f"""
        SELECT event_id, {_SESSION} AS session_id, {_ITEM} AS item_id, event_type AS category
        FROM events WHERE event_type NOT IN ('signup', 'error')""",
    "purchase_utility": _sql(
        "lines",
        """SELECT session_id, item_id, CAST(price AS DOUBLE) AS price, quantity,
                  CAST(utility AS DOUBLE) AS utility FROM lines""",
    ),
    "price_quantile": """
        SELECT round(quantile_cont(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE), 0.95), 6) AS quantile
        FROM events WHERE event_type = 'purchase'""",
    "trim_outliers": _sql(
        "trimmed", "SELECT session_id, event_id, item_id, CAST(price AS DOUBLE) AS price FROM trimmed"
    ),
    "utility_trimmed": _sql(
        "trimmed", "SELECT item_id, CAST(sum(utility) AS DOUBLE) AS utility FROM trimmed GROUP BY item_id"
    ),
    "price_histogram": _sql(
        "trimmed",
        """SELECT b AS bin, count(bin) AS rows FROM range(1, 21) t(b) LEFT JOIN binned ON bin = b GROUP BY b""",
        ends="SELECT min(price) AS lo, max(price) AS hi FROM trimmed",
        binned="""
            SELECT least(20, greatest(1, ceil(CAST(price - lo AS DOUBLE) * 20 / CAST(hi - lo AS DOUBLE)))) AS bin
            FROM trimmed, ends""",
    ),
    "limit_rows": _sql("clicks", "SELECT * FROM clicks ORDER BY session_id, ts, event_id LIMIT 1000"),
    "top_clicked_items": _sql(
        "clicks",
        "SELECT item_id, count(*) AS events FROM clicks GROUP BY item_id ORDER BY events DESC, item_id LIMIT 10",
    ),
    "conversion_rate": _sql(
        "clicks purchases",
        """SELECT CAST(sum(1 - b) AS BIGINT) AS clicks, CAST(sum(b) AS BIGINT) AS purchases,
                  count(DISTINCT session_id) AS sessions,
                  count(DISTINCT CASE WHEN b = 1 THEN session_id END) AS buying_sessions,
                  round(sum(b) / sum(1 - b), 6) AS buy_click_ratio,
                  round(count(DISTINCT CASE WHEN b = 1 THEN session_id END) / count(DISTINCT session_id), 6)
                      AS buying_session_ratio
           FROM (SELECT session_id, 0 AS b FROM clicks UNION ALL SELECT session_id, 1 FROM purchases)""",
    ),
    "popularity_share": _sql(
        "clicks",
        """SELECT count(*) AS items, count(*) FILTER (place <= ceil(0.2 * n)) AS top_items,
                  CAST(sum(events) AS BIGINT) AS events,
                  CAST(sum(events) FILTER (place <= ceil(0.2 * n)) AS BIGINT) AS top_events,
                  round(sum(events) FILTER (place <= ceil(0.2 * n)) / sum(events), 6) AS top_share
           FROM (SELECT events, row_number() OVER (ORDER BY events DESC, item_id) AS place, count(*) OVER () AS n
                 FROM (SELECT item_id, count(*) AS events FROM clicks GROUP BY item_id))""",
    ),
    "stage_counts": _sql(
        "clicks matrix",
        """SELECT 'clicks' AS stage, count(*) AS rows FROM clicks
           UNION ALL SELECT 'purchases', count(*) FROM purchases
           UNION ALL SELECT 'items', count(*) FROM high_items
           UNION ALL SELECT 'pairs', count(*) FROM cps
           UNION ALL SELECT 'weights', count(*) FROM matrix""",
    ),
    "distinct_session_items": _sql("clicks", "SELECT DISTINCT session_id, item_id FROM clicks"),
    "click_sequences": _sql(
        "clicks",
        """SELECT session_id, part, string_agg(CAST(item_id AS VARCHAR), '>' ORDER BY ts, event_id) AS items,
                  string_agg(CAST(item_id AS VARCHAR), '>' ORDER BY ts, event_id) AS sequence
           FROM parts GROUP BY session_id, part""",
        parts=_PARTED.format("clicks"),
    ),
    "purchase_sequences": _sql(
        "purchases",
        """SELECT session_id, part, string_agg(item_id || ':' || utility, '>' ORDER BY ts, event_id) AS purchases
           FROM parts GROUP BY session_id, part""",
        parts=_PARTED.format("purchases"),
    ),
    "prefixspan": _frequent("steps", 0.05),
    "prefixspan_items": _frequent("tens", 0.002),
    "prefixspan_orders": _frequent("states", 0.1),
    "session_utility": _sql(
        "purchases", "SELECT session_id, CAST(sum(utility) AS DOUBLE) AS utility FROM purchases GROUP BY session_id"
    ),
    "item_utility": _sql("items", "SELECT item_id, CAST(utility AS DOUBLE) AS utility FROM items"),
    "swu": _sql("swu", "SELECT item_id, CAST(swu AS DOUBLE) AS swu FROM swu"),
    "promising_items": _sql(
        "swu total", "SELECT item_id, CAST(swu AS DOUBLE) AS swu FROM swu WHERE swu >= 0.01 * (SELECT u FROM total)"
    ),
    "huspm_items": _sql("high_items", "SELECT item_id, CAST(utility AS DOUBLE) AS utility FROM high_items"),
    "huspm_items_none": _sql(
        "items total", "SELECT item_id, CAST(utility AS DOUBLE) AS utility FROM items WHERE utility >= (SELECT u FROM total)"
    ),
    "huspm_sharded_max": _sql(
        "shards", "SELECT item_id, CAST(max(utility) AS DOUBLE) AS utility FROM shards GROUP BY item_id"
    ),
    "huspm_sharded_sum": _sql(
        "shards", "SELECT item_id, CAST(sum(utility) AS DOUBLE) AS utility FROM shards GROUP BY item_id"
    ),
    "swu_orders": _sql(
        "lines",
        """SELECT item_id, CAST(sum(total) AS DOUBLE) AS swu
           FROM (SELECT DISTINCT session_id, item_id FROM lines)
           JOIN (SELECT session_id, sum(utility) AS total FROM lines GROUP BY session_id) USING (session_id)
           GROUP BY item_id""",
    ),
    "huspm_orders": _sql(
        "lines",
        """SELECT item_id, CAST(utility AS DOUBLE) AS utility
           FROM (SELECT item_id, CAST(sum(utility) AS DECIMAL(18,2)) AS utility FROM lines GROUP BY item_id)
           WHERE utility >= 0.0006 * (SELECT CAST(sum(utility) AS DECIMAL(18,2)) FROM lines)""",
    ),
    "huspm_len2": _valuable("spent", "0.0003", range(2, 3), itemsets=False),
    "huspm_patterns": _valuable("spent", "0.0003", range(1, 4), itemsets=False),
    "huspm_itemsets": _valuable("years", "0.004", range(1, 4), itemsets=True),
    "cps": _sql("cps", "SELECT click_item, purchase_item, cps FROM cps"),
    "cps_probability": _sql(
        "chance", "SELECT click_item, purchase_item, cps, round(probability, 6) AS probability FROM chance"
    ),
    "whuom": _sql("matrix", "SELECT click_item, purchase_item, CAST(weight AS DOUBLE) AS weight FROM matrix"),
    "matrix_roundtrip": _sql(
        "matrix", "SELECT click_item, purchase_item, CAST(weight AS DOUBLE) AS weight FROM matrix"
    ),
    "whuom_left": _sql(
        "cps high_items",
        """SELECT click_item, purchase_item, CAST(weight AS DOUBLE) AS weight
           FROM (SELECT click_item, purchase_item, cps * coalesce(utility, 0) AS weight
                 FROM cps LEFT JOIN high_items ON purchase_item = item_id)
           WHERE weight > 0""",
    ),
    "whuom_log": _sql(
        "cps high_items",
        """SELECT click_item, purchase_item, round(ln(cps) * CAST(utility AS DOUBLE), 6) AS weight
           FROM cps JOIN high_items ON purchase_item = item_id
           WHERE ln(cps) * CAST(utility AS DOUBLE) > 0""",
    ),
    "recommend_scores": _sql("scores", "SELECT session_id, item_id, CAST(score AS DOUBLE) AS score FROM scores"),
    "recommend_topk": _sql("ranked", _TOP.format("ranked", 5)),
    "recommend_lists": _sql(
        "ranked",
        """SELECT session_id, string_agg(CAST(item_id AS VARCHAR), '>' ORDER BY rank) AS items,
                  string_agg(CAST(CAST(score AS DECIMAL(18,2)) AS VARCHAR), '>' ORDER BY rank) AS scores
           FROM ranked WHERE rank <= 5 GROUP BY session_id""",
    ),
    "stream_scores": _sql(
        "clicks matrix",
        """SELECT session_id, string_agg(CAST(item_id AS VARCHAR), '>' ORDER BY rank) AS items,
                  string_agg(CAST(CAST(score AS DECIMAL(18,2)) AS VARCHAR), '>' ORDER BY rank) AS scores
           FROM placed WHERE rank <= 5 GROUP BY session_id""",
        young="""
            SELECT DISTINCT session_id, item_id AS click_item
            FROM (SELECT *, max(ts) OVER (PARTITION BY session_id) AS newest FROM clicks)
            WHERE ts >= newest - INTERVAL 6 HOUR""",
        placed="""
            SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY score DESC, item_id) AS rank
            FROM (SELECT session_id, purchase_item AS item_id, sum(weight) AS score
                  FROM young JOIN matrix USING (click_item) GROUP BY ALL)""",
    ),
    "recommend_unseen": _sql(
        "scores bought",
        _TOP.format("fresh", 5),
        fresh="""
            SELECT session_id, item_id, score,
                   row_number() OVER (PARTITION BY session_id ORDER BY score DESC, item_id) AS rank
            FROM scores s
            WHERE NOT EXISTS (SELECT 1 FROM bought b
                              WHERE b.session_id = s.session_id AND b.purchase_item = s.item_id)""",
    ),
    "recommend_holdout": _sql(
        "clicked bought",
        _TOP.format("best", 5),
        folds="SELECT f FROM range(0, 5) t(f)",
        known="""
            SELECT f, item_id, CAST(sum(utility) AS DECIMAL(18,2)) AS utility
            FROM purchases JOIN folds ON session_id % 5 <> f GROUP BY f, item_id""",
        sums="SELECT f, CAST(sum(utility) AS DECIMAL(18,2)) AS u FROM known GROUP BY f",
        pairs="""
            SELECT f, click_item, purchase_item, count(*) AS n
            FROM clicked JOIN bought USING (session_id) JOIN folds ON session_id % 5 <> f
            GROUP BY f, click_item, purchase_item""",
        trained="""
            SELECT p.f, click_item, purchase_item, n * utility AS weight
            FROM pairs p JOIN known k ON p.f = k.f AND purchase_item = item_id JOIN sums s ON s.f = p.f
            WHERE utility >= 0.01 * u AND utility > 0""",
        best="""
            SELECT session_id, purchase_item AS item_id, sum(weight) AS score,
                   row_number() OVER (PARTITION BY session_id ORDER BY sum(weight) DESC, purchase_item) AS rank
            FROM clicked c JOIN trained t ON t.click_item = c.click_item AND session_id % 5 = f
            GROUP BY session_id, purchase_item""",
    ),
    "recommend_click_only": _sql(
        "ranked",
        _TOP.format("ranked", 5) + " AND session_id NOT IN (SELECT session_id FROM purchases)",
    ),
    # Each gain is an amount rounded half up to six places, in whole millionths.
    "expected_profit": _sql(
        "clicked ranked cps high_items",
        """SELECT session_id, CAST(sum(gain) AS DOUBLE) / 1000000 AS expected_profit
           FROM (SELECT r.session_id, r.item_id, max(gain) AS gain
                 FROM ranked r JOIN clicked c ON c.session_id = r.session_id
                 JOIN gains h ON h.click_item = c.click_item AND h.purchase_item = r.item_id
                 WHERE rank <= 5 GROUP BY r.session_id, r.item_id)
           GROUP BY session_id""",
        gains="""
            SELECT click_item, purchase_item,
                   (CAST(utility * 100 AS HUGEINT) * cps * 20000 + n) // (2 * n) AS gain
            FROM cps JOIN (SELECT click_item, count(*) AS n FROM clicked GROUP BY click_item) USING (click_item)
            JOIN high_items ON purchase_item = item_id""",
    ),
    "mine_and_recommend": _sql("ranked", _TOP.format("ranked", 3)),
}
