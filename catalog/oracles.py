"""SQL that DuckDB runs on the same tables, one text per registered query."""

from catalog import samples as P

# The sample ledger (see FIXTURES.md), then the building blocks that several queries share.
LEDGER = """
WITH f_tx AS (
  SELECT o_orderkey, o_custkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS n_block,
         sha256(concat('t', CAST(o_orderkey AS VARCHAR))) AS tx_id, o_orderdate,
         lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_key
  FROM orders),
f_block AS (
  SELECT n_block, count(*) AS transaction_count,
         TIMESTAMP '1995-01-01' + INTERVAL 1 HOUR * (24 * n_block + (n_block % 3) * 18) AS block_timestamp
  FROM f_tx GROUP BY n_block),
blocks AS (
  SELECT sha256(concat('b', CAST(n_block AS VARCHAR))) AS block_hash, n_block, block_timestamp, CAST(1 AS BIGINT) AS version,
         CASE WHEN n_block = 0 THEN repeat('0', 64) ELSE sha256(concat('b', CAST(n_block - 1 AS VARCHAR))) END AS prev_block_hash,
         sha256(concat('m', CAST(n_block AS VARCHAR))) AS merkle_root, n_block * 7919 AS nonce, CAST(1 AS BIGINT) AS bits,
         transaction_count * 250 AS size, transaction_count * 1000 AS weight, transaction_count, block_timestamp AS processed_at
  FROM f_block
  UNION ALL
  SELECT sha256(concat('b', CAST(n_block AS VARCHAR))), n_block, block_timestamp - INTERVAL 1 DAY, 1, repeat('0', 64),
         sha256(concat('m', CAST(n_block AS VARCHAR))), 0, 1, 0, 0, 0, block_timestamp - INTERVAL 1 DAY
  FROM f_block WHERE n_block % 10 = 5),
k_out AS (
  SELECT t.n_block, t.tx_id, CAST(l_linenumber - 1 AS BIGINT) AS output_index, CAST(round(l_extendedprice * 100) AS BIGINT) AS value,
         CASE WHEN t.prev_key IS NULL THEN 1 ELSE 0 END AS is_coinbase, l_suppkey % 20 AS kind,
         CASE WHEN l_suppkey % 20 IN (0, 1) THEN CAST([] AS VARCHAR[])
              WHEN l_suppkey % 20 = 2 THEN [concat('s', CAST(l_suppkey AS VARCHAR)), concat('p', CAST(l_partkey AS VARCHAR))]
              ELSE [concat('s', CAST(l_suppkey AS VARCHAR))] END AS addresses,
         l_shipdate AS created_at, l_partkey AS tie_part, l_suppkey AS tie_supp
  FROM lineitem JOIN f_tx t ON l_orderkey = t.o_orderkey),
k_in AS (
  SELECT t.n_block, t.tx_id, CAST(l_linenumber - 1 AS BIGINT) AS input_index,
         CASE WHEN t.o_orderkey % 997 = 0 THEN sha256(concat('x', CAST(p.o_orderkey AS VARCHAR))) ELSE p.tx_id END AS prev_tx_hash,
         CAST(l_linenumber - 1 AS BIGINT) AS prev_tx_index, 0 AS is_coinbase, l_suppkey % 20 AS kind,
         l_shipdate AS created_at, l_partkey AS tie_part, l_suppkey AS tie_supp
  FROM f_tx t JOIN f_tx p ON t.prev_key = p.o_orderkey JOIN lineitem ON l_orderkey = p.o_orderkey
  UNION ALL
  SELECT n_block, tx_id, 0, repeat('0', 64), 4294967295, 1, 1, o_orderdate, 0, 0
  FROM f_tx WHERE prev_key IS NULL),
tran_out AS (
  SELECT *, CASE WHEN kind IN (0, 1) THEN 0 WHEN kind = 2 THEN 2 ELSE 1 END AS address_count,
         CASE WHEN kind = 0 THEN 1 ELSE 0 END AS is_op_return, CASE WHEN kind = 1 THEN 1 ELSE 0 END AS is_unknown,
         CASE WHEN kind = 2 THEN 1 ELSE 0 END AS is_multisig, CASE WHEN kind BETWEEN 3 AND 8 THEN 1 ELSE 0 END AS is_p2pkh,
         CASE WHEN kind BETWEEN 9 AND 11 THEN 1 ELSE 0 END AS is_p2sh, CASE WHEN kind BETWEEN 12 AND 14 THEN 1 ELSE 0 END AS is_p2wpkh,
         CASE WHEN kind BETWEEN 15 AND 16 THEN 1 ELSE 0 END AS is_p2wsh, CASE WHEN kind BETWEEN 17 AND 18 THEN 1 ELSE 0 END AS is_p2tr,
         CASE WHEN kind = 0 THEN 'op_return' WHEN kind = 1 THEN 'unknown' WHEN kind = 2 THEN 'multisig' WHEN kind <= 8 THEN 'pubkeyhash'
              WHEN kind <= 11 THEN 'p2sh' WHEN kind <= 14 THEN 'p2wpkh' WHEN kind <= 16 THEN 'p2wsh' WHEN kind <= 18 THEN 'p2tr'
              ELSE 'pubkey' END AS script_type,
         lower(hex(concat('o', CAST(kind AS VARCHAR)))) AS script_hex
  FROM k_out),
tran_in AS (
  SELECT *, CASE WHEN kind BETWEEN 12 AND 16 THEN 1 ELSE 0 END AS is_segwit,
         CASE WHEN kind BETWEEN 12 AND 16 THEN CAST(1 AS BIGINT) ELSE 0 END AS witness_count,
         CASE WHEN kind BETWEEN 12 AND 16 THEN lower(hex(concat('w', CAST(tie_part AS VARCHAR)))) ELSE '' END AS witness_data,
         CASE WHEN kind = 2 THEN 'multisig' WHEN kind BETWEEN 3 AND 8 THEN 'pubkeyhash' WHEN kind BETWEEN 9 AND 11 THEN 'p2sh'
              WHEN kind BETWEEN 12 AND 14 THEN 'p2wpkh' WHEN kind BETWEEN 15 AND 16 THEN 'p2wsh' WHEN kind = 19 THEN 'pubkey'
              ELSE 'unknown' END AS script_type,
         lower(hex(concat('i', CAST(kind AS VARCHAR)))) AS script_hex, 4294967295 - kind AS sequence_number, kind + 41 AS input_size
  FROM k_in),
lb AS (SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY n_block ORDER BY processed_at DESC) = 1),
li AS (SELECT * FROM tran_in
       QUALIFY row_number() OVER (PARTITION BY n_block, tx_id, input_index ORDER BY created_at DESC, tie_part DESC, tie_supp DESC) = 1),
lo AS (SELECT *, CASE WHEN address_count > 0 THEN addresses[1] WHEN is_op_return = 1 THEN ''
                 ELSE concat('_', upper(tx_id), '_', CAST(output_index AS VARCHAR)) END AS address
       FROM (SELECT * FROM tran_out
             QUALIFY row_number() OVER (PARTITION BY n_block, tx_id, output_index ORDER BY created_at DESC, tie_part DESC, tie_supp DESC) = 1)),
spent AS (
  SELECT i.n_block, i.tx_id, i.input_index, i.prev_tx_hash, i.prev_tx_index, o.value, o.address
  FROM li i JOIN lo o ON i.prev_tx_hash = o.tx_id AND i.prev_tx_index = o.output_index WHERE i.is_coinbase = 0),
entries AS (
  SELECT n_block, tx_id, address, -value AS sats, 0 AS is_coinbase FROM spent
  UNION ALL SELECT n_block, tx_id, address, value, is_coinbase FROM lo),
tv AS (
  SELECT e.n_block, b.block_timestamp AS time, tx_id, address, CAST(sum(sats) AS BIGINT) AS sats, is_coinbase
  FROM entries e JOIN lb b ON e.n_block = b.n_block
  GROUP BY e.n_block, b.block_timestamp, tx_id, address, is_coinbase HAVING sum(sats) <> 0),
net AS (
  SELECT e.n_block, b.block_timestamp AS time, tx_id, CAST(sum(sats) AS BIGINT) AS sats
  FROM entries e JOIN lb b ON e.n_block = b.n_block
  GROUP BY e.n_block, b.block_timestamp, tx_id HAVING sum(sats) <> 0),
tm AS (
  SELECT strftime(date_trunc('month', time), '%Y-%m-%d') AS time_month, address, CAST(sum(sats) AS BIGINT) AS sats
  FROM tv GROUP BY ALL),
done AS (SELECT strftime(date_trunc('month', max(block_timestamp)) - INTERVAL 1 MONTH, '%Y-%m-%d') AS m FROM lb),
orphan AS (SELECT b.* FROM lb b WHERE n_block > 0 AND NOT EXISTS (SELECT 1 FROM lb p WHERE p.block_hash = b.prev_block_hash)),
log AS (SELECT max(n_block) AS n_block, max(block_timestamp) AS version FROM blocks GROUP BY date_trunc('month', block_timestamp)),
cp AS (SELECT n_block FROM log ORDER BY version DESC, n_block DESC LIMIT 1),
c1 AS (SELECT CAST(0 AS BIGINT) AS n_block WHERE NOT EXISTS (SELECT 1 FROM blocks WHERE n_block = 0)),
c2 AS (SELECT r.n AS n_block FROM (SELECT unnest(range(1, (SELECT max(n_block) + 1 FROM blocks))) AS n) r
       WHERE r.n NOT IN (SELECT n_block FROM blocks)),
c3i AS (SELECT b.n_block, b.transaction_count AS declared, count(DISTINCT i.tx_id) AS actual
        FROM lb b LEFT JOIN li i ON b.n_block = i.n_block GROUP BY ALL HAVING b.transaction_count <> count(DISTINCT i.tx_id)),
c3o AS (SELECT b.n_block, b.transaction_count AS declared, count(DISTINCT i.tx_id) AS actual
        FROM lb b LEFT JOIN lo i ON b.n_block = i.n_block GROUP BY ALL HAVING b.transaction_count <> count(DISTINCT i.tx_id)),
whole AS (SELECT 1 AS one, n_block FROM blocks),
damaged AS (SELECT * FROM blocks WHERE n_block NOT IN @DAMAGED@),
c4 AS (
  SELECT DISTINCT 'tran_in not in blocks' AS direction, n_block FROM li WHERE n_block NOT IN (SELECT n_block FROM lb)
  UNION ALL SELECT 'blocks not in tran_in', n_block FROM lb WHERE n_block NOT IN (SELECT n_block FROM li)
  UNION ALL SELECT DISTINCT 'tran_out not in blocks', n_block FROM lo WHERE n_block NOT IN (SELECT n_block FROM lb)
  UNION ALL SELECT 'blocks not in tran_out', n_block FROM lb WHERE n_block NOT IN (SELECT n_block FROM lo)),
c5 AS (SELECT n_block, upper(block_hash) AS block_hash, upper(prev_block_hash) AS prev_block_hash FROM lb b
       WHERE n_block > 0 AND NOT EXISTS (SELECT 1 FROM lb p WHERE p.block_hash = b.prev_block_hash AND p.n_block + 1 = b.n_block)),
c6i AS (SELECT DISTINCT upper(tx_id) AS tx_hash FROM li a WHERE NOT EXISTS (SELECT 1 FROM lo b WHERE a.n_block = b.n_block AND a.tx_id = b.tx_id)),
c6o AS (SELECT DISTINCT upper(tx_id) AS tx_hash FROM lo a WHERE NOT EXISTS (SELECT 1 FROM li b WHERE a.n_block = b.n_block AND a.tx_id = b.tx_id)),
c7 AS (SELECT prev_tx_hash, tx_id, input_index FROM li WHERE prev_tx_hash <> repeat('0', 64) AND prev_tx_hash NOT IN (SELECT tx_id FROM lo)),
c8 AS (SELECT n_block, count(*) AS n_outputs FROM lo WHERE tx_id IN (
         SELECT tx_id FROM net WHERE (time, tx_id) NOT IN (SELECT (time, tx_id) FROM tv WHERE n_block NOT BETWEEN @LOST_FROM@ AND @LOST_TO@))
       GROUP BY n_block),
first_group AS (
  SELECT 1 AS "check", CAST(n_block AS VARCHAR) AS key, 'first block is missing' AS detail FROM c1
  UNION ALL SELECT 2, CAST(n_block AS VARCHAR), 'block is missing' FROM c2
  UNION ALL SELECT 3, CAST(n_block AS VARCHAR), concat('declared ', declared, ', in tran_in ', actual) FROM c3i
  UNION ALL SELECT 3, CAST(n_block AS VARCHAR), concat('declared ', declared, ', in tran_out ', actual) FROM c3o
  UNION ALL SELECT 4, CAST(n_block AS VARCHAR), direction FROM c4),
second_group AS (
  SELECT 5 AS "check", CAST(n_block AS VARCHAR) AS key, concat('parent not found: ', prev_block_hash) AS detail FROM c5
  UNION ALL SELECT 6, tx_hash, 'in tran_in, not in tran_out' FROM c6i
  UNION ALL SELECT 6, tx_hash, 'in tran_out, not in tran_in' FROM c6o
  UNION ALL SELECT 7, prev_tx_hash, concat('in transaction ', tx_id, ', input ', input_index) FROM c7)
"""

_LATEST_BLOCKS = """SELECT block_hash, n_block, block_timestamp, version, prev_block_hash, merkle_root, nonce, bits, size,
    weight, transaction_count, processed_at FROM lb"""
_TURNOVER = "SELECT n_block, time, tx_id, address, sats, is_coinbase FROM tv"
_MONTHLY = "SELECT time_month, address, sats FROM tm"
_MONTHLY_DONE = _MONTHLY + " WHERE time_month <= (SELECT m FROM done)"
_CONTENTS = """SELECT b.n_block, b.block_hash, (SELECT count(*) FROM li WHERE li.n_block = b.n_block) AS n_in,
    (SELECT count(*) FROM lo WHERE lo.n_block = b.n_block) AS n_out FROM lb b"""
_FIRST_GAP = "SELECT min(n) FROM (SELECT unnest(range(@START@, (SELECT max(n_block) + 2 FROM lb))) AS n) WHERE n NOT IN (SELECT n_block FROM lb)"

def _coins(sats: str) -> str:
    return f"CAST(CAST({sats} * CAST('0.00000001' AS DECIMAL(9, 8)) AS DECIMAL(28, 8)) AS VARCHAR)"


SELECTS = {
    "latest_blocks": _LATEST_BLOCKS,
    "latest_tran_in": """SELECT n_block, tx_id, input_index, prev_tx_hash, prev_tx_index, is_coinbase, created_at, kind,
        tie_part, tie_supp FROM li""",
    "latest_tran_out": """SELECT n_block, tx_id, output_index, value, is_coinbase, is_op_return, address_count,
        array_to_string(addresses, ',') AS addresses, created_at, kind, tie_part, tie_supp FROM lo""",
    "blocks_h": """SELECT upper(block_hash) AS block_hash_h, n_block, block_timestamp, version,
        upper(prev_block_hash) AS prev_block_hash_h, upper(merkle_root) AS merkle_root_h, nonce, bits, size, weight,
        transaction_count, processed_at FROM blocks""",
    "tran_in_h": """SELECT n_block, upper(tx_id) AS tx_id_h, input_index, upper(prev_tx_hash) AS prev_tx_hash_h, prev_tx_index,
        sequence_number, script_hex, script_type, is_segwit, witness_count, witness_data, input_size, is_coinbase FROM tran_in""",
    "tran_out_h": """SELECT n_block, upper(tx_id) AS tx_id_h, output_index, value, script_hex, script_type, is_p2pkh, is_p2sh,
        is_p2wpkh, is_p2wsh, is_p2tr, is_multisig, is_unknown, is_op_return, address_count,
        array_to_string(addresses, ',') AS addresses,
        CASE address_count WHEN 0 THEN '' WHEN 1 THEN script_type ELSE concat(script_type, ',', script_type) END AS address_types,
        created_at FROM tran_out""",
    "tx_block": "SELECT tx_id, max(n_block) AS n_block FROM tran_out GROUP BY tx_id",
    "flatten_blocks": """SELECT block_hash, prev_block_hash, merkle_root, n_block, block_timestamp, version, nonce, bits, size,
        weight, transaction_count FROM lb""",
    "flatten_inputs": """SELECT n_block, tx_id, input_index, prev_tx_hash, prev_tx_index, sequence_number, script_hex, script_type,
        max(is_segwit) OVER (PARTITION BY n_block, tx_id) AS is_segwit,
        witness_count, witness_data, input_size, is_coinbase FROM li""",
    "flatten_outputs": """SELECT n_block, tx_id, output_index, value, is_coinbase, script_hex, script_type, is_p2pkh, is_p2sh,
        is_p2wpkh, is_p2wsh, is_p2tr, is_multisig, is_unknown, is_op_return, address_count,
        array_to_string(addresses, ',') AS addresses,
        CASE address_count WHEN 0 THEN '' WHEN 1 THEN script_type ELSE concat(script_type, ',', script_type) END AS address_types
        FROM lo""",
    "load_new": _CONTENTS,
    "bulk_load": _CONTENTS,
    "turnover_incremental": _TURNOVER,
    "turnover_m_incremental": _MONTHLY_DONE,
    "turnover_after_rewind": _TURNOVER,
    "turnover_m_after_rewind": _MONTHLY_DONE,
    "turnover_rebuild": _TURNOVER,
    "turnover_from_unspent": _TURNOVER,
    "unspent_outputs": """SELECT tx_id, output_index, n_block, value, address FROM lo
        WHERE (tx_id, output_index) NOT IN (SELECT (prev_tx_hash, prev_tx_index) FROM li WHERE is_coinbase = 0)""",
    "top_wallets_kept": """SELECT address, CAST(sum(sats) AS BIGINT) AS sats, count(tx_id) AS n_tx FROM tv GROUP BY address
        HAVING sum(sats) > @MIN_SATS@ ORDER BY sum(sats) DESC, address LIMIT 10""",
    "balance_kept": "SELECT CAST(coalesce(sum(sats), 0) AS BIGINT) AS sats FROM tv WHERE address = '@ADDRESS@'",
    "latest_of_compacted": "SELECT n_block, tx_id, output_index, value, address, is_coinbase FROM lo",
    "turnover_m_by_differences": """SELECT strftime(date_trunc('month', time), '%Y-%m-%d') AS time_month, address,
        CAST(sum(sats) AS BIGINT) AS sats, count(*) AS n_rows FROM tv GROUP BY ALL""",
    "stream_load": _TURNOVER + f" WHERE n_block < ({_FIRST_GAP.replace('@START@', '0')})",
    "stream_load_restart": _TURNOVER,
    "stream_load_parts": _TURNOVER,
    "turnover_m_month_reopened": _MONTHLY_DONE,
    "stored_top_wallets": f"""SELECT address, {_coins('sum(sats)')} AS value, count(tx_id) AS n_tx FROM tv GROUP BY address
        HAVING sum(sats) > @MIN_SATS@ ORDER BY sum(sats) DESC, address LIMIT 10""",
    "stored_balance": f"SELECT {_coins('sum(sats)')} AS value FROM tv WHERE address = '@ADDRESS@'",
    "stored_balance_hybrid": f"SELECT {_coins('sum(sats)')} AS value FROM tv WHERE address = '@ADDRESS@'",
    "blocks_in_range": "SELECT n_block, block_hash, block_timestamp FROM blocks WHERE n_block BETWEEN @RANGE_FROM@ AND @RANGE_TO@",
    "block_time_at": "SELECT max(block_timestamp) AS time FROM lb WHERE n_block = @POINT_BLOCK@",
    "max_block_before": "SELECT max(n_block) AS n_block FROM blocks WHERE block_timestamp < TIMESTAMP '@BEFORE_TIME@'",
    "months_to_process": """SELECT DISTINCT time_month FROM tm
        WHERE time_month BETWEEN '@FIRST_MONTH@' AND (SELECT m FROM done) ORDER BY time_month""",
    "stored_hashes": """SELECT DISTINCT prev_block_hash AS block_hash FROM blocks
        WHERE prev_block_hash IN (SELECT block_hash FROM blocks)""",
    "spent_outputs": "SELECT * FROM spent",
    "inputs_with_time": """SELECT i.n_block, tx_id, input_index, prev_tx_hash, prev_tx_index, is_coinbase, block_timestamp AS time
        FROM li i JOIN lb b ON i.n_block = b.n_block""",
    "semi_blocks": """SELECT n_block, tx_id, input_index, prev_tx_hash, prev_tx_index, is_coinbase FROM li
        WHERE n_block IN (SELECT n_block FROM blocks WHERE n_block > @CUT_BLOCK@)""",
    "semi_block_tx": """SELECT n_block, tx_id, output_index, value, address, is_coinbase FROM lo WHERE (n_block, tx_id) IN (
        SELECT (max(n_block), tx_id) FROM tran_out WHERE tx_id IN (SELECT prev_tx_hash FROM li WHERE is_coinbase = 0) GROUP BY tx_id)""",
    "missing_range_ends": "SELECT DISTINCT n_block - 1 AS end_block FROM orphan",
    "parent_height": """SELECT block_hash, CAST(0 AS BIGINT) AS n_block FROM lb WHERE prev_block_hash = repeat('0', 64)
        UNION ALL SELECT b.block_hash, p.n_block + 1 FROM lb b JOIN lb p ON b.prev_block_hash = p.block_hash""",
    "output_address": "SELECT n_block, tx_id, output_index, address FROM lo",
    "ledger_entries": "SELECT n_block, tx_id, address, sats, is_coinbase FROM entries",
    "turnover": _TURNOVER,
    "turnover_of_blocks": _TURNOVER + " WHERE n_block > @CUT_BLOCK@",
    "turnover_m": _MONTHLY,
    "tx_net": "SELECT n_block, time, tx_id, sats FROM net",
    "top_wallets": """SELECT address, CAST(sum(sats) AS BIGINT) AS sats, count(tx_id) AS n_tx FROM tv GROUP BY address
        HAVING sum(sats) > @MIN_SATS@ ORDER BY sum(sats) DESC, address LIMIT 10""",
    "address_balance": "SELECT CAST(coalesce(sum(sats), 0) AS BIGINT) AS sats FROM tv WHERE address = '@ADDRESS@'",
    "address_balance_hybrid": """SELECT CAST(coalesce(sum(sats), 0) AS BIGINT) AS sats FROM (
        SELECT sats FROM tm WHERE time_month < '@CUT_MONTH@' AND address = '@ADDRESS@'
        UNION ALL SELECT sats FROM tv WHERE time >= TIMESTAMP '@CUT_MONTH@' AND address = '@ADDRESS@')""",
    "to_coin": """SELECT address, CAST(CAST(sum(sats) * CAST('0.00000001' AS DECIMAL(9, 8)) AS DECIMAL(18, 8)) AS VARCHAR) AS value
        FROM tv GROUP BY address""",
    "block_count": "SELECT count(*) AS n_rows, count(*) FILTER (WHERE n_block = 0) AS n_genesis_rows FROM blocks",
    "block_bounds": "SELECT min(n_block) AS min_block, max(n_block) AS max_block FROM blocks",
    "pending_block_stats": """SELECT count(DISTINCT n_block) AS n_blocks, min(n_block) AS min_block, max(n_block) AS max_block
        FROM blocks WHERE n_block > @CUT_BLOCK@""",
    "distinct_blocks": "SELECT DISTINCT n_block FROM tran_in",
    "last_stored_block": "SELECT coalesce(max(n_block), -1) AS n_block FROM blocks",
    "last_completed_month": "SELECT m AS time_month FROM done",
    "change_point": "SELECT n_block FROM cp",
    "rewind_point": """SELECT n_block FROM (SELECT min(b.n_block) - 1 AS n_block FROM blocks b JOIN lb USING (n_block)
        WHERE b.processed_at <> lb.processed_at) WHERE n_block < (SELECT n_block FROM cp)""",
    "affected_blocks": "SELECT DISTINCT n_block FROM blocks WHERE n_block > @CUT_BLOCK@",
    "hash32": """SELECT n_block, processed_at, CASE WHEN n_block % 2 = 0 THEN upper(prev_block_hash) ELSE repeat('0', 64) END AS hash
        FROM blocks""",
    "to_hex": "SELECT n_block, processed_at, CASE WHEN n_block % 2 = 0 THEN block_hash ELSE '' END AS hash FROM blocks",
    "month_id": """SELECT n_block, processed_at, CAST(year(block_timestamp) * 100 + month(block_timestamp) AS INTEGER) AS month_id
        FROM blocks""",
    "month_bounds": """SELECT n_block, processed_at, strftime(date_trunc('month', block_timestamp), '%Y-%m-%d') AS this_month,
        strftime(date_trunc('month', block_timestamp) + INTERVAL 1 MONTH, '%Y-%m-%d') AS following,
        strftime(date_trunc('month', block_timestamp) - INTERVAL 1 MONTH, '%Y-%m-%d') AS preceding FROM blocks""",
    "time_format": """SELECT n_block, strftime(block_timestamp, '%Y-%m-%d %H:%M:%S') AS time_text,
        strftime(block_timestamp, '%Y-%m') AS month_text FROM blocks""",
    "script_type_in": "SELECT n_block, tx_id, input_index, kind, script_type FROM tran_in",
    "script_type_out": "SELECT n_block, tx_id, output_index, kind, script_type FROM tran_out",
    "missing_ranges": """SELECT start_block, end_block FROM (
        SELECT DISTINCT coalesce((SELECT max(b.n_block) FROM lb b WHERE b.n_block <= o.n_block - 1), -1) + 1 AS start_block,
               o.n_block - 1 AS end_block FROM orphan o) WHERE start_block <= end_block""",
    "unloaded_blocks": """SELECT n AS n_block FROM (SELECT unnest(range(0, (SELECT max(n_block) + @AHEAD@ + 1 FROM lb))) AS n)
        WHERE n NOT IN (SELECT n_block FROM lb) ORDER BY n""",
    "assign_heights": "SELECT block_hash, n_block FROM lb WHERE n_block NOT IN (SELECT n_block FROM orphan)",
    "new_blocks": "SELECT DISTINCT block_hash FROM blocks WHERE n_block > @CUT_BLOCK@",
    "pending_blocks": f"""SELECT block_hash FROM lb WHERE n_block > greatest(@WAITING_CUT@,
        ({_FIRST_GAP.replace('@START@', '@WAITING_CUT@')}))""",
    "resume_file": """SELECT max(printf('blocks-%06d', n_block // @FILE_BLOCKS@)) AS source_file FROM blocks
        WHERE n_block <= @CUT_BLOCK@""",
    "resume_from_summary": """SELECT max(printf('blocks-%06d', n_block // @FILE_BLOCKS@)) AS source_file FROM blocks
        WHERE n_block <= @CUT_BLOCK@""",
    "file_summary": """SELECT printf('blocks-%06d', n_block // @FILE_BLOCKS@) AS source_file, min(n_block) AS low, max(n_block) AS high,
        CAST(count(DISTINCT block_hash) AS INTEGER) AS n_hashes FROM blocks GROUP BY 1""",
    "check_genesis": "SELECT n_block FROM c1",
    "check_genesis_damaged": "SELECT CAST(0 AS BIGINT) AS n_block WHERE NOT EXISTS (SELECT 1 FROM damaged WHERE n_block = 0)",
    "check_block_sequence": "SELECT n_block FROM c2",
    "check_tx_count_in": "SELECT n_block, declared, actual FROM c3i",
    "check_tx_count_out": "SELECT n_block, declared, actual FROM c3o",
    "check_n_block": "SELECT direction, n_block FROM c4",
    "check_n_block_damaged": """
        SELECT DISTINCT 'tran_in not in blocks' AS direction, n_block FROM li WHERE n_block NOT IN (SELECT n_block FROM damaged)
        UNION ALL SELECT DISTINCT 'blocks not in tran_in', n_block FROM damaged WHERE n_block NOT IN (SELECT n_block FROM li)
        UNION ALL SELECT DISTINCT 'tran_out not in blocks', n_block FROM lo WHERE n_block NOT IN (SELECT n_block FROM damaged)
        UNION ALL SELECT DISTINCT 'blocks not in tran_out', n_block FROM damaged WHERE n_block NOT IN (SELECT n_block FROM lo)""",
    "check_prev_hash": "SELECT n_block, block_hash, prev_block_hash FROM c5",
    "check_tx_in_out": "SELECT tx_hash FROM c6i",
    "check_tx_out_in": "SELECT tx_hash FROM c6o",
    "check_prev_tx": "SELECT prev_tx_hash, tx_id, input_index FROM c7",
    "check_turnover_complete": "SELECT n_block, n_outputs FROM c8",
    "check_turnover_complete_range": "SELECT n_block, n_outputs FROM c8 WHERE n_block BETWEEN @CHECK_FROM@ AND @CHECK_TO@",
    "integrity_messages": """SELECT line FROM (
        SELECT concat('check ', "check", ': ', count(*), ' violations') AS line FROM second_group GROUP BY "check"
        UNION ALL SELECT concat('check ', "check", ': ', key, ': ', detail) FROM (
            SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY key, detail) AS n FROM second_group) WHERE n <= @REPORTED@)""",
    "integrity_report": """SELECT * FROM first_group UNION ALL
        SELECT * FROM second_group WHERE NOT EXISTS (SELECT 1 FROM first_group)""",
    "integrity_report_second_group": """SELECT * FROM second_group
        UNION ALL SELECT 8, CAST(n_block AS VARCHAR), concat(n_outputs, ' outputs not in turnover') FROM c8""",
}


def _fill(text: str) -> str:
    for name in sorted(vars(P), key=len, reverse=True):
        text = text.replace(f"@{name}@", str(getattr(P, name)))
    return text


def oracle_sql() -> dict:
    return {name: _fill(LEDGER + select) for name, select in SELECTS.items()}
