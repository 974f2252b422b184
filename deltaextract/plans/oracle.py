"""The registered queries once more, as SQL for an independent engine (DuckDB dialect) over the same tables."""

from __future__ import annotations

import re

_SALT = "test-salt"


def _group_hash(row: str) -> str:
    words = [f"cast(sum(CAST('0x' || substr(sha256({row}), {1 + 15 * k}, 15) AS BIGINT)) AS varchar)" for k in range(4)]
    return f"sha256(concat_ws('~', {', '.join(words)}, cast(count(*) AS varchar)))"


def _pseudonym(value: str) -> str:
    return f"upper(sha256('{_SALT}' || {value}))"


_PARENT_ROW = "concat_ws('~', provider_code, gp_code, status, total_price, order_date, priority)"
_CHILD_ROW = "concat_ws('~', line_no, part_id, quantity, price, return_flag, ship_date)"


def _framed(*columns: str) -> str:
    parts = [f"coalesce(length(cast({c} AS varchar)) || ':' || cast({c} AS varchar), '-')" for c in columns]
    return f"concat_ws('~', {', '.join(parts)})"


def _fingerprints(source: str, cohort: str, row: str) -> str:
    return f"""
        SELECT rec_id, fy, {_group_hash(row)} AS hash, count(*) AS hash_count FROM {source} t
        WHERE EXISTS (SELECT 1 FROM {cohort} k WHERE k.rec_id = t.rec_id) GROUP BY rec_id, fy"""


def _by_folder(source: str, cohort: str, row: str) -> str:
    return f"""
        SELECT rec_id, fy, source_period, {_group_hash(row)} AS hash, count(*) AS hash_count FROM {source} t
        WHERE EXISTS (SELECT 1 FROM {cohort} k WHERE k.rec_id = t.rec_id) GROUP BY rec_id, fy, source_period"""


def _unfiled(source: str) -> str:
    return f"""
        SELECT * REPLACE (CASE WHEN rec_id % 11 = 0 THEN NULL WHEN rec_id % 13 = 0 THEN '1990/91' ELSE fy END AS fy), fy AS source_period FROM {source}"""


def _changed_by_folder(current: str, previous: str) -> str:
    return f"""
        SELECT c.rec_id FROM {current} c
        WHERE c.source_period IN (SELECT fy FROM changed_periods)
              AND NOT EXISTS (SELECT 1 FROM {previous} p
                              WHERE p.source_period IN (SELECT fy FROM changed_periods) AND p.rec_id = c.rec_id AND p.hash = c.hash)"""


def _cohort(parent: str) -> str:
    return f"""
        SELECT DISTINCT e.rec_id, e.fy FROM {parent} e
        LEFT JOIN (SELECT DISTINCT org_code FROM fx_providers WHERE region_code = 'ASIA') p ON e.provider_code = p.org_code
        LEFT JOIN (SELECT DISTINCT org_code FROM fx_gp WHERE region_code = 'BUILDING') g ON e.gp_code = g.org_code
        WHERE p.org_code IS NOT NULL OR g.org_code IS NOT NULL"""


def _changed(current: str, previous: str) -> str:
    return f"""
        SELECT c.rec_id FROM {current} c WHERE NOT EXISTS (SELECT 1 FROM {previous} p
        WHERE p.fy IN (SELECT fy FROM changed_periods) AND p.rec_id = c.rec_id AND p.hash = c.hash)"""


def _merged(current: str, previous: str) -> str:
    return f"""
        SELECT rec_id, fy, hash, hash_count FROM {current}
        UNION ALL SELECT rec_id, fy, hash, hash_count FROM {previous} WHERE fy NOT IN (SELECT fy FROM changed_periods)"""


# Named steps; each may use the ones before it.
_STEPS: dict[str, str] = {
    "fx_parent_cur": """
        SELECT o.o_orderkey AS rec_id, concat(cast(o.y AS varchar), '/', lpad(cast((o.y + 1) % 100 AS varchar), 2, '0')) AS fy,
               concat('P', cast(c.c_nationkey AS varchar)) AS provider_code, concat('G', cast(o.o_custkey AS varchar)) AS gp_code,
               o.o_orderstatus AS status, cast(o.o_totalprice AS decimal(18,2)) AS total_price,
               cast(o.o_orderdate AS date) AS order_date, o.o_orderpriority AS priority
        FROM (SELECT *, CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS y FROM orders) o
        JOIN customer c ON o.o_custkey = c.c_custkey""",
    "fx_child_cur": """
        SELECT l.l_orderkey AS rec_id, p.fy, l.l_linenumber AS line_no, l.l_partkey AS part_id,
               cast(l.l_quantity AS decimal(18,2)) AS quantity, cast(l.l_extendedprice AS decimal(18,2)) AS price,
               CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_returnflag END AS return_flag, cast(l.l_shipdate AS date) AS ship_date
        FROM lineitem l JOIN fx_parent_cur p ON l.l_orderkey = p.rec_id""",
    "fx_parent_prev": """
        SELECT rec_id, fy, provider_code, gp_code, status,
               CASE WHEN rec_id % 37 = 0 THEN cast(total_price + 1 AS decimal(18,2)) ELSE total_price END AS total_price,
               order_date, priority
        FROM fx_parent_cur WHERE rec_id % 50 <> 0
        UNION ALL
        SELECT rec_id + 10000000, fy, provider_code, gp_code, status, total_price, order_date, priority
        FROM fx_parent_cur WHERE rec_id % 41 = 0""",
    "fx_child_prev": "SELECT * FROM fx_child_cur WHERE rec_id % 50 <> 0 AND NOT (rec_id % 29 = 0 AND line_no = 1)",
    "fx_parent_multi": """
        SELECT rec_id, fy, status, total_price FROM fx_parent_cur
        UNION ALL
        SELECT rec_id, '2000/01' AS fy, status, total_price FROM fx_parent_cur WHERE rec_id % 61 = 0 AND fy <> '2000/01'""",
    "fx_providers": """
        SELECT concat('P', cast(n.n_nationkey AS varchar)) AS org_code, r.r_name AS region_code
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "fx_gp": "SELECT concat('G', cast(c_custkey AS varchar)) AS org_code, c_mktsegment AS region_code FROM customer",
    "fx_folders_cur": """
        SELECT DISTINCT src AS data_source, concat('FY', substring(fy, 1, 4), '-', substring(fy, 6, 2), '/') AS folder,
               CASE WHEN fy >= '1998/99' THEN timestamp '2024-02-01 00:00:00' ELSE timestamp '2024-01-01 00:00:00' END AS last_modified
        FROM fx_parent_cur CROSS JOIN (SELECT 'parent' AS src UNION ALL SELECT 'child') s""",
    "fx_folders_prev": """
        SELECT data_source, folder, timestamp '2024-01-01 00:00:00' AS last_modified FROM fx_folders_cur
        WHERE folder <> 'FY2001-02/'""",
    "changed_periods": r"""
        SELECT DISTINCT folder, regexp_replace(folder, '^FY([0-9]{4})-([0-9]{2})/$', '\1/\2') AS fy,
               cast(substring(folder, 3, 4) AS integer) AS first_year
        FROM fx_folders_cur c
        WHERE NOT EXISTS (SELECT 1 FROM fx_folders_prev p WHERE p.data_source = c.data_source AND p.folder = c.folder
                          AND p.last_modified = c.last_modified)""",
    "cohort_keys": _cohort("fx_parent_cur"),
    "cohort_keys_prev": _cohort("fx_parent_prev"),
    "cohort_in_changed": "SELECT k.* FROM cohort_keys k WHERE k.fy IN (SELECT fy FROM changed_periods)",
    "hash_parent_cur": _fingerprints("fx_parent_cur", "cohort_in_changed", _PARENT_ROW),
    "hash_child_cur": _fingerprints("fx_child_cur", "cohort_in_changed", _CHILD_ROW),
    "hash_parent_prev": _fingerprints("fx_parent_prev", "cohort_keys_prev", _PARENT_ROW),
    "hash_child_prev": _fingerprints("fx_child_prev", "cohort_keys_prev", _CHILD_ROW),
    "changed_parent": _changed("hash_parent_cur", "hash_parent_prev"),
    "changed_child": _changed("hash_child_cur", "hash_child_prev"),
    "changed_keys": "SELECT rec_id FROM changed_parent UNION SELECT rec_id FROM changed_child",
    "delta_parent": f"""
        SELECT {_pseudonym("rec_id")} AS record_id, provider_code, {_pseudonym("gp_code")} AS gp_pseudonym,
               {_pseudonym("gp_code")} AS practice_pseudonym, status, total_price, order_date AS ordered_on, priority
        FROM fx_parent_cur t
        WHERE t.fy IN (SELECT fy FROM changed_periods) AND EXISTS (SELECT 1 FROM changed_keys k WHERE k.rec_id = t.rec_id)""",
    "delta_child": f"""
        SELECT {_pseudonym("rec_id")} AS record_id, line_no, part_id AS part_ref, quantity, price, return_flag,
               ship_date AS shipped_on
        FROM fx_child_cur t
        WHERE t.fy IN (SELECT fy FROM changed_periods) AND EXISTS (SELECT 1 FROM changed_keys k WHERE k.rec_id = t.rec_id)""",
    "merge_snapshot": _merged("hash_parent_cur", "hash_parent_prev"),
    "merge_snapshot_child": _merged("hash_child_cur", "hash_child_prev"),
    "live_keys": f"SELECT DISTINCT {_pseudonym('rec_id')} AS record_id FROM merge_snapshot",
    "record_counts": """
        SELECT 'parent' AS entity, count(*) AS records FROM fx_parent_cur
        UNION ALL SELECT 'child', count(*) FROM fx_child_cur
        UNION ALL SELECT 'conversations', count(*) FROM conversations""",
    # Some records have left the cohort, some have lost all their child rows.
    "cohort_left": "SELECT * FROM cohort_in_changed WHERE rec_id % 7 <> 0",
    "hash_parent_left": _fingerprints("fx_parent_cur", "cohort_left", _PARENT_ROW),
    "hash_child_vanished": _fingerprints("(SELECT * FROM fx_child_cur WHERE rec_id % 31 <> 0)", "cohort_left", _CHILD_ROW),
    "changed_parent_left": _changed("hash_parent_left", "hash_parent_prev"),
    "changed_child_vanished": _changed("hash_child_vanished", "hash_child_prev"),
    # Rows without an FY, or with another than their folder's.
    "parent_unfiled": _unfiled("fx_parent_cur"),
    "child_unfiled": _unfiled("fx_child_cur"),
    "parent_unfiled_prev": _unfiled("fx_parent_prev"),
    "child_unfiled_prev": _unfiled("fx_child_prev"),
    "folder_parent_cur": _by_folder("parent_unfiled", "cohort_in_changed", _PARENT_ROW),
    "folder_child_cur": _by_folder("child_unfiled", "cohort_in_changed", _CHILD_ROW),
    "folder_parent_prev": _by_folder("parent_unfiled_prev", "cohort_keys_prev", _PARENT_ROW),
    "folder_child_prev": _by_folder("child_unfiled_prev", "cohort_keys_prev", _CHILD_ROW),
    "feed_lines": """
        SELECT 'parent' AS output, concat(record_id, '|', provider_code, '|', gp_pseudonym, '|', practice_pseudonym, '|', status,
               '|', total_price, '|', ordered_on, '|', priority) AS line FROM delta_parent
        UNION ALL
        SELECT 'child', concat(record_id, '|', line_no, '|', part_ref, '|', quantity, '|', price, '|', coalesce(return_flag, ''),
               '|', shipped_on) FROM delta_child
        UNION ALL SELECT 'parentDeletes', record_id FROM live_keys""",
    "family_prev": """
        SELECT 0 AS member, rec_id, hash FROM hash_parent_prev WHERE fy IN (SELECT fy FROM changed_periods)
        UNION ALL SELECT 1, rec_id, hash FROM hash_child_prev WHERE fy IN (SELECT fy FROM changed_periods)""",
    "family_left": """
        SELECT 0 AS member, rec_id, hash FROM hash_parent_left UNION ALL SELECT 1, rec_id, hash FROM hash_child_vanished""",
}

_QUERIES: dict[str, str] = {
    "config_select": f"""
        SELECT rec_id AS record_id, {_pseudonym("gp_code")} AS gp_pseudonym, {_pseudonym("gp_code")} AS practice_pseudonym,
               status, substring(priority, 1, 1) AS priority_class, '' AS not_supplied, order_date AS ordered_on
        FROM fx_parent_cur WHERE total_price > 1000""",
    "missing_column_default": "SELECT rec_id, '' AS not_supplied FROM fx_parent_cur",
    "multi_alias": "SELECT rec_id, provider_code AS treating_provider, provider_code AS billing_provider FROM fx_parent_cur",
    "transform_chain": """
        SELECT rec_id, substring(substring(priority, 3, 20) || status || provider_code, 1, 4) AS priority FROM fx_parent_cur""",
    "pseudonymise": f"""
        SELECT rec_id, line_no, {_pseudonym("part_id")} AS part_id, {_pseudonym("return_flag")} AS return_flag FROM fx_child_cur""",
    "config_filter": f"""
        SELECT {_pseudonym("rec_id")} AS rec_id, line_no FROM fx_child_cur WHERE quantity > 30 AND rec_id > 10""",
    "fn_to_date": "SELECT rec_id, CASE WHEN rec_id % 10 <> 0 THEN order_date END AS ordered FROM fx_parent_cur",
    "fn_expr": "SELECT rec_id, concat(priority, '/', status) AS priority FROM fx_parent_cur",
    "fn_concat": "SELECT rec_id, line_no, quantity || price || return_flag AS quantity FROM fx_child_cur",
    "fn_instr": "SELECT rec_id, cast(instr(priority, 'E') AS integer) AS priority FROM fx_parent_cur",
    "fn_left": "SELECT rec_id, left(priority, 3) AS priority FROM fx_parent_cur",
    "fn_substring": """
        SELECT rec_id, substring(priority, 3, 4) AS priority, substring(provider_code, 1, 2) AS provider_code FROM fx_parent_cur""",
    "fn_folder_to_fy": r"""
        SELECT folder, regexp_replace(folder, '^FY([0-9]{4})-([0-9]{2})/$', '\1/\2') AS fy,
               try_cast(regexp_replace(folder, '^FY([0-9]{4})-([0-9]{2})/$', '\1') AS integer) AS first_year
        FROM (SELECT folder FROM fx_folders_cur UNION SELECT 'old-' || folder FROM fx_folders_cur)""",
    "row_hash": f"""
        SELECT rec_id, line_no, sha256({_CHILD_ROW}) AS hash,
               sha256({_framed("line_no", "part_id", "quantity", "price", "return_flag", "ship_date")}) AS framed_hash
        FROM fx_child_cur""",
    "org_filter": """
        SELECT DISTINCT org_code FROM fx_providers WHERE region_code = 'ASIA'
        UNION ALL SELECT DISTINCT org_code FROM fx_gp WHERE region_code = 'BUILDING'""",
    "cohort_keys": "SELECT * FROM cohort_keys",
    "cohort_keys_large_lists": "SELECT * FROM cohort_keys",
    "changed_periods": "SELECT * FROM changed_periods",
    "changed_periods_floor": "SELECT * FROM changed_periods WHERE first_year >= 2000",
    "changed_folder_list": "SELECT string_agg(folder, ',' ORDER BY folder) AS folders FROM changed_periods",
    "entity_paths": """
        SELECT data_source, folder FROM fx_folders_cur
        WHERE folder IN (SELECT folder FROM changed_periods) AND NOT (data_source = 'child' AND folder = 'FY1999-00/')""",
    "folder_state_roundtrip": "SELECT data_source, folder, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified FROM fx_folders_cur",
    "folder_mod_times": "SELECT data_source, folder, true AS is_last, true AS after_first FROM fx_folders_cur",
    "fingerprint_parent": "SELECT * FROM hash_parent_cur",
    "fingerprint_child": "SELECT * FROM hash_child_cur",
    "fingerprint_filtered": "SELECT * FROM hash_child_cur",
    "fingerprint_one_pass": f"""
        SELECT rec_id, fy, {_group_hash(_PARENT_ROW)} AS hash, count(*) AS hash_count, true AS matched FROM fx_parent_cur t
        WHERE EXISTS (SELECT 1 FROM cohort_in_changed k WHERE k.rec_id = t.rec_id) GROUP BY rec_id, fy""",
    "fingerprint_one_pass_fan": f"""
        SELECT rec_id, fy, {_group_hash(_PARENT_ROW)} AS hash, count(*) AS hash_count, bool_or(here) AS matched
        FROM (SELECT *, EXISTS (SELECT 1 FROM cohort_keys k WHERE k.rec_id = t.rec_id) AS here FROM fx_parent_cur t
              UNION ALL SELECT * REPLACE ('2000/01' AS fy, 'none' AS provider_code, 'none' AS gp_code), false FROM fx_parent_cur WHERE rec_id % 3 = 0) t
        WHERE EXISTS (SELECT 1 FROM cohort_keys k WHERE k.rec_id = t.rec_id) GROUP BY rec_id, fy""",
    "fingerprint_split": f"""
        SELECT rec_id % 3 AS rec_id, fy, {_group_hash(_CHILD_ROW)} AS hash, count(*) AS hash_count FROM fx_child_cur GROUP BY rec_id % 3, fy""",
    "key_join_semi": f"""
        SELECT rec_id, fy, {_group_hash("concat_ws('~', status, total_price)")} AS hash, count(*) AS hash_count
        FROM fx_parent_multi e WHERE EXISTS (SELECT 1 FROM cohort_keys k WHERE k.rec_id = e.rec_id) GROUP BY rec_id, fy""",
    "key_join_inner": f"""
        SELECT e.rec_id, e.fy, {_group_hash("concat_ws('~', status, total_price)")} AS hash, count(*) AS hash_count
        FROM fx_parent_multi e JOIN (SELECT DISTINCT rec_id, fy FROM fx_parent_multi) k ON e.rec_id = k.rec_id
        WHERE EXISTS (SELECT 1 FROM cohort_keys c WHERE c.rec_id = e.rec_id)
        GROUP BY e.rec_id, e.fy""",
    "changed_parent": "SELECT * FROM changed_parent",
    "changed_child": "SELECT * FROM changed_child",
    "changed_keys": "SELECT * FROM changed_keys",
    "changed_keys_from_buckets": "SELECT * FROM changed_keys",
    "changed_keys_vanished": """
        SELECT rec_id FROM changed_parent_left UNION SELECT rec_id FROM changed_child_vanished
        UNION SELECT rec_id FROM hash_child_prev p WHERE p.fy IN (SELECT fy FROM changed_periods)
              AND EXISTS (SELECT 1 FROM cohort_left k WHERE k.rec_id = p.rec_id)
              AND NOT EXISTS (SELECT 1 FROM hash_child_vanished c WHERE c.rec_id = p.rec_id)""",
    "delta_parent": "SELECT * FROM delta_parent",
    "delta_child": "SELECT * FROM delta_child",
    "csv_roundtrip": f"""
        SELECT {_pseudonym("rec_id")} AS record_id, cast(line_no AS varchar) AS line_no, cast(part_id AS varchar) AS part_ref,
               cast(quantity AS varchar) AS quantity, cast(price AS varchar) AS price, return_flag,
               cast(ship_date AS varchar) AS shipped_on
        FROM fx_child_cur""",
    "record_counts": "SELECT * FROM record_counts",
    "part_counts": """
        SELECT entity, records, cast(target_rows AS bigint) AS target_rows,
               cast(greatest(1, records // target_rows + 1) AS bigint) AS parts
        FROM record_counts CROSS JOIN (SELECT unnest([1000, 15000, 10000000]) AS target_rows) t""",
    "control_file": """
        SELECT 'cExtractFileName|~|nRecordCount|~|cDatum|~|dPeriodStart|~|dPeriodEnd' AS line
        UNION ALL
        SELECT entity || '/part-' || lpad(cast(i - 1 AS varchar), 5, '0') || '|~|' || cast(records AS varchar)
               || '|~|order_date|~|1970-04-01 00:00:00|~|2999-01-01 00:00:00'
        FROM (SELECT entity, records, unnest(range(1, records // 4000 + 2)) AS i FROM record_counts)""",
    "snapshot_roundtrip": "SELECT * FROM hash_child_prev",
    "bootstrap_snapshot": "SELECT rec_id FROM hash_parent_cur",
    "previous_in_scope": "SELECT * FROM hash_parent_prev WHERE fy IN (SELECT fy FROM changed_periods)",
    "carry_over": "SELECT * FROM hash_parent_prev WHERE fy NOT IN (SELECT fy FROM changed_periods)",
    "merge_snapshot": "SELECT * FROM merge_snapshot",
    "merge_snapshot_child": "SELECT * FROM merge_snapshot_child",
    "live_keys": "SELECT * FROM live_keys",
    "run_feed": """
        SELECT output, line FROM feed_lines
        UNION ALL SELECT 'control', 'cExtractFileName|~|nRecordCount|~|cDatum|~|dPeriodStart|~|dPeriodEnd'
        UNION ALL SELECT 'control', name || '/part-00000|~|' || cast(records AS varchar) || '|~|order_date|~|1970-04-01 00:00:00|~|2999-01-01 00:00:00'
        FROM (SELECT 'parent' AS name, count(*) AS records FROM delta_parent UNION ALL SELECT 'child', count(*) FROM delta_child
              UNION ALL SELECT 'parentDeletes', count(*) FROM live_keys)""",
    # A row's FY matters to nothing that is delivered, and what was delivered once is not delivered again.
    "run_feed_without_fy": """
        SELECT output, line FROM feed_lines UNION ALL SELECT 'again_parentDeletes', record_id FROM live_keys""",
    # The remaining folders hold the same rows as before.
    "run_feed_retired_folder": f"""
        SELECT DISTINCT 'parentDeletes' AS output, {_pseudonym("rec_id")} AS line FROM hash_parent_prev
        WHERE fy > (SELECT min(fy) FROM fx_parent_prev)""",
    "vanished_periods": r"""
        SELECT data_source, folder, regexp_replace(folder, '^FY([0-9]{4})-([0-9]{2})/$', '\1/\2') AS fy, cast(substring(folder, 3, 4) AS integer) AS first_year
        FROM fx_folders_cur
        WHERE CASE data_source WHEN 'parent' THEN cast(substring(folder, 3, 4) AS integer) % 2 = 0 ELSE substring(folder, 3, 4) IN ('1996', '1997') END
              AND cast(substring(folder, 3, 4) AS integer) >= 1995""",
    "mixed_file_types": """
        SELECT rec_id, fy, cast(line_no AS bigint) AS line_no, cast(part_id AS bigint) AS part_id, cast(quantity AS double) AS quantity,
               CASE WHEN line_no <= 3 THEN ship_date END AS ship_date, fy AS source_period
        FROM fx_child_cur""",
    "fingerprint_by_folder": "SELECT * FROM folder_child_cur WHERE source_period IN (SELECT fy FROM changed_periods)",
    "changed_keys_by_folder": f"""
        SELECT rec_id FROM ({_changed_by_folder("folder_parent_cur", "folder_parent_prev")})
        UNION SELECT rec_id FROM ({_changed_by_folder("folder_child_cur", "folder_child_prev")})""",
    "merge_snapshot_by_folder": """
        SELECT * FROM folder_parent_cur WHERE source_period IN (SELECT fy FROM changed_periods)
        UNION ALL SELECT * FROM folder_parent_prev WHERE source_period NOT IN (SELECT fy FROM changed_periods)""",
    "family_changes": """
        SELECT rec_id,
               EXISTS (SELECT 1 FROM family_left c WHERE c.rec_id = k.rec_id
                       AND NOT EXISTS (SELECT 1 FROM family_prev p WHERE p.member = c.member AND p.rec_id = c.rec_id AND p.hash = c.hash)) AS changed,
               EXISTS (SELECT 1 FROM family_prev p WHERE p.rec_id = k.rec_id) AS known,
               EXISTS (SELECT 1 FROM family_prev p WHERE p.rec_id = k.rec_id AND p.member = 1)
               AND NOT EXISTS (SELECT 1 FROM family_left c WHERE c.rec_id = k.rec_id AND c.member = 1) AS lost
        FROM (SELECT rec_id FROM family_left UNION SELECT rec_id FROM family_prev) k""",
}


def _with_steps(query: str) -> str:
    """Prefix a query with the steps it uses, directly or through other steps."""
    needed: set[str] = set()
    texts = [query]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for step in (words & _STEPS.keys()) - needed:
            needed.add(step)
            texts.append(_STEPS[step])
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in _STEPS.items() if name in needed)
    return f"WITH {steps}\n{query}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_steps(query) for name, query in _QUERIES.items()}
