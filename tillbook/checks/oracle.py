"""The registered queries restated as SQL over the same tables.

Written independently of the DataFrame code: lookups are VALUES lists, dates go
through ``try_strptime``, windows are plain. Common steps are CTEs.
"""

from __future__ import annotations

SHARE = "0.40"

_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
    "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END"


def _dots(c: str) -> str:
    return f"replace(format('{{:,}}', {c}), ',', '.')"


def _rp(c: str) -> str:
    bare = f"regexp_replace({c}, '[Rp\\s.,]', '', 'g')"
    number = f"CASE WHEN regexp_matches({bare}, '^[+-]?[0-9]+$') THEN TRY_CAST({bare} AS BIGINT) END"
    return (
        f"TRY_CAST(CASE WHEN strpos({c}, ',') > 0 THEN floor(({number}) / 100.0) "
        f"ELSE {number} END AS INTEGER)"
    )


def _num(c: str) -> str:
    return f"TRY_CAST(TRY_CAST({c} AS DOUBLE) AS INTEGER)"


def _order_day(c: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({c}, '%d/%m/%Y'), try_strptime({c}, '%Y-%m-%d')) AS DATE)"
    )


def _expense_day(c: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'), "
        f"try_strptime({c}, '%d/%m/%Y')) AS DATE)"
    )


ORDERS_TEXT = f"""
orders_base AS (
  SELECT o_orderkey AS k, o_custkey AS buyer, o_orderstatus = 'P' AS synthetic, o_orderstatus,
    CAST(CASE WHEN year(o_orderdate) >= 1999 THEN o_orderdate + INTERVAL 4 YEAR
         ELSE o_orderdate END AS DATE) AS day,
    CAST(floor(o_totalprice) AS BIGINT) AS price,
    CASE WHEN o_orderkey % 131 = 0 THEN CAST(floor(o_totalprice) AS BIGINT)
         ELSE ([-20000, 0, 5000, 8000, 10000, 50000, 1234, NULL, 0])[o_orderkey % 9 + 1] END AS off
  FROM orders
),
orders_text AS (
  SELECT k,
    CAST(CASE WHEN k % 50 = 1 THEN k - 1 ELSE k END AS VARCHAR) AS no,
    CASE WHEN synthetic OR k % 4 = 0 THEN strftime(day, '%Y-%m-%d')
         WHEN k % 499 = 3 THEN 'belum tahu'
         WHEN k % 4 = 2 THEN strftime(day, '%-d/%-m/%Y')
         ELSE strftime(day, '%d/%m/%Y') END AS tanggal,
    CASE WHEN k % 53 = 0 THEN NULL
         WHEN buyer % 97 = 0 THEN 'Kost no 12'
         WHEN buyer % 97 = 1 THEN 'Temen Putri'
         WHEN buyer % 97 <= 20 THEN 'Kak Pelanggan ' || buyer
         WHEN buyer % 97 <= 30 THEN 'Mas Pelanggan ' || buyer
         ELSE 'Pelanggan ' || buyer END AS nama,
    (['On Cloud', 'cloud tec', 'Nike AJ1', 'adidas samba', 'NB', 'New Balance', 'Converse High',
      'gatau', '???', '', NULL, 'vans', 'CloudTec'])[k % 13 + 1] AS sepatu,
    CASE WHEN k % 17 <> 0 THEN (['Deep Clean', 'deep clean express', 'Fast Clean', 'Tas', 'KARPET',
      'sendal', 'Reparasi lem', 'Cuci'])[k % 8 + 1] END AS cuci,
    CASE WHEN synthetic OR k % 5 = 2 THEN CAST(price AS VARCHAR)
         WHEN k % 5 = 0 THEN 'Rp' || {_dots('price')}
         WHEN k % 5 = 1 THEN 'Rp' || {_dots('price')} || ',00'
         WHEN k % 5 = 3 THEN 'Rp ' || {_dots('price')}
         WHEN k % 10 = 4 THEN 'gratis' END AS harga,
    CASE WHEN synthetic THEN CAST(off AS VARCHAR) ELSE 'Rp' || {_dots('off')} END AS diskon,
    CASE WHEN synthetic THEN CAST(CASE WHEN k % 101 = 0 THEN 0 ELSE price - coalesce(off, 0) END AS VARCHAR)
         ELSE 'Rp' || {_dots('CASE WHEN k % 101 = 0 THEN 0 ELSE price - coalesce(off, 0) END')}
         END AS total,
    (['BCA', 'bayar cash', NULL, '', 'BLU', '  x '])[k % 6 + 1] AS keterangan,
    (['Paid', 'paid', '', 'N/A', 'NULL', 'nan', NULL])[k % 7 + 1] AS status,
    (['Vian', 'Rio', 'Amory', NULL])[buyer % 4 + 1] AS pekerja,
    CASE o_orderstatus WHEN 'F' THEN 'real_2023' WHEN 'O' THEN 'real_2025'
         ELSE 'synthetic_orders' END AS data_source,
    synthetic AS is_synthetic
  FROM orders_base
)"""

RAW_ORDERS = ORDERS_TEXT + f""",
raw_orders AS (
  SELECT CAST(no AS BIGINT) AS order_no, {_order_day('tanggal')} AS order_date,
    {_na('nama')} AS customer_name, {_na('sepatu')} AS shoe_type, {_na('cuci')} AS service_type,
    CASE WHEN is_synthetic THEN {_num('harga')} ELSE {_rp('harga')} END AS price,
    CASE WHEN is_synthetic THEN {_num('diskon')} ELSE {_rp('diskon')} END AS discount,
    CASE WHEN is_synthetic THEN {_num('total')} ELSE {_rp('total')} END AS total_price,
    {_na('keterangan')} AS notes, {_na('status')} AS payment_status, pekerja AS worker,
    data_source, is_synthetic
  FROM orders_text
)"""

EXPENSES_TEXT = f"""
expenses_base AS (
  SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, l_suppkey AS supplier,
    l_returnflag, l_returnflag = 'N' AS synthetic, CAST(l_shipdate AS DATE) AS day,
    CAST(floor(l_extendedprice) AS BIGINT) AS price, CAST(l_quantity AS INTEGER) AS qty,
    CAST(floor(l_extendedprice) AS BIGINT) * CAST(l_quantity AS INTEGER)
      + CASE WHEN l_orderkey % 11 = 0 THEN 1000 ELSE 0 END AS amount
  FROM lineitem
),
expenses_text AS (
  SELECT
    CASE WHEN synthetic THEN strftime(day, '%Y-%m-%d')
         WHEN k % 10 = 0 THEN NULL
         WHEN k % 97 = 3 THEN 'belum tahu'
         WHEN k % 4 = 1 THEN strftime(day, '%m/%d/%Y')
         WHEN k % 4 = 2 THEN strftime(day, '%d/%m/%Y')
         ELSE strftime(day, '%Y-%m-%d') END AS tanggal,
    CASE WHEN k % 23 <> 0 THEN 'Barang ' || (part % 1000) END AS barang,
    CASE WHEN k % 20 = 0 THEN ' Gaji ' WHEN k % 10 = 0 THEN 'GAJI' WHEN line = 7 THEN ''
         WHEN supplier % 29 = 0 THEN NULL ELSE 'Brand ' || (supplier % 25) END AS merk,
    CASE WHEN synthetic OR part % 4 = 2 THEN CAST(price AS VARCHAR)
         WHEN part % 4 = 0 THEN 'Rp' || {_dots('price')}
         WHEN part % 4 = 1 THEN 'Rp' || {_dots('price')} || ',00'
         WHEN part % 12 <> 3 THEN 'Rp ' || {_dots('price')} END AS harga,
    CASE WHEN synthetic THEN CAST(qty AS VARCHAR)
         WHEN k % 37 = 1 THEN qty || '.5' WHEN k % 37 = 2 THEN 'abc' WHEN k % 37 = 3 THEN qty || 'e0'
         WHEN k % 501 = 9 THEN '-' || qty ELSE CAST(qty AS VARCHAR) END AS jumlah,
    CASE WHEN k % 41 = 0 THEN NULL WHEN synthetic THEN CAST(amount AS VARCHAR)
         ELSE 'Rp' || {_dots('amount')} END AS total,
    CASE WHEN k % 10 = 0 THEN (['Januari', ' februari', 'MARET', 'April', 'Mei ', 'juni', 'Juli',
           'agustus', 'September', 'oktober', 'November', 'DESEMBER', 'x', NULL])[part % 14 + 1]
         WHEN line % 3 = 0 THEN '' WHEN line % 3 = 1 THEN 'ok' END AS keterangan,
    CASE l_returnflag WHEN 'R' THEN 'real_2023' WHEN 'A' THEN 'real_2025'
         ELSE 'synthetic_supplies' END AS data_source,
    synthetic AS is_synthetic
  FROM expenses_base
),
bulan(nama_bulan, nomor) AS (
  VALUES ('januari', 1), ('februari', 2), ('maret', 3), ('april', 4), ('mei', 5), ('juni', 6),
    ('juli', 7), ('agustus', 8), ('september', 9), ('oktober', 10), ('november', 11), ('desember', 12)
),
expenses_dated AS (
  SELECT e.*, {_expense_day('e.tanggal')} AS own_day, nomor AS bulan_gaji,
    CASE WHEN lower(trim(e.merk)) = 'gaji' THEN make_date(2023, nomor, 25) END AS payday
  FROM expenses_text e LEFT JOIN bulan ON nama_bulan = lower(trim(e.keterangan))
)"""

RAW_EXPENSES = EXPENSES_TEXT + f""",
raw_expenses AS (
  SELECT
    CASE WHEN is_synthetic THEN own_day ELSE coalesce(own_day, payday) END AS expense_date,
    {_na('barang')} AS item_name, {_na('merk')} AS brand,
    CASE WHEN is_synthetic THEN {_num('harga')} ELSE {_rp('harga')} END AS unit_price,
    {_num('jumlah')} AS quantity,
    CASE WHEN is_synthetic THEN {_num('total')} ELSE {_rp('total')} END AS total_price,
    {_na('keterangan')} AS notes, data_source, is_synthetic,
    CASE WHEN NOT is_synthetic THEN own_day IS NULL AND payday IS NOT NULL END AS is_date_imputed
  FROM expenses_dated
)"""

_BRANDS = """
brand_names(spelling, brand) AS (
  VALUES ('on cloud', 'On Running'), ('cloud', 'On Running'), ('cloudtech', 'On Running'),
    ('cloud tec', 'On Running'), ('nb', 'New Balance'), ('new balance', 'New Balance'),
    ('gatau', 'Unknown'), ('???', 'Unknown'), ('lokal', 'Unknown'), ('', 'Unknown')
)"""


def _brand(shoe: str, match: str) -> str:
    return (
        f"coalesce({match}, CASE regexp_extract(lower({shoe}), '^(nike|adidas|converse)') "
        f"WHEN 'nike' THEN 'Nike' WHEN 'adidas' THEN 'Adidas' WHEN 'converse' THEN 'Converse' "
        f"ELSE {shoe} END, 'Unknown')"
    )


_NAME = (
    "CASE customer_name WHEN 'Kost no 12' THEN 'Pelanggan Kost 12' "
    "WHEN 'Temen Putri' THEN 'Teman Putri' ELSE customer_name END"
)
_PAYMENT = (
    "CASE WHEN strpos({0}, 'BCA') > 0 THEN 'Transfer' "
    "WHEN right(coalesce({0}, 'cash'), 4) = 'cash' THEN 'Cash' ELSE 'Unknown' END"
)
_ITEM = "CASE WHEN list_contains(['tas', 'karpet', 'sendal'], lower({0})) THEN {0} ELSE 'sepatu' END"
_CLEAN = (
    "CASE WHEN regexp_matches(lower({0}), '^((tas|karpet|sendal)$|deep)') THEN 'deep clean' "
    "WHEN left(lower({0}), 4) = 'fast' THEN 'fast clean' "
    "WHEN left(lower({0}), 8) = 'reparasi' THEN 'reparasi' ELSE lower({0}) END"
)
_DISCOUNT = (
    "CASE {0} WHEN 0 THEN 'none' WHEN 5000 THEN 'special' WHEN 8000 THEN 'promo' "
    "WHEN 10000 THEN 'loyalty' ELSE CASE WHEN {0} < 0 THEN 'surcharge' "
    "WHEN {0} > 10000 THEN 'manual' ELSE 'unknown' END END"
)

STAGED = RAW_ORDERS + "," + _BRANDS + f""",
staged AS (
  SELECT order_no, order_date, CAST(year(order_date) AS INTEGER) AS year,
    CAST(month(order_date) AS INTEGER) AS month, CAST(weekofyear(order_date) AS INTEGER) AS week,
    {_NAME} AS customer_name_clean, {_PAYMENT.format('notes')} AS payment_method,
    {_ITEM.format('service_type')} AS item_type, {_CLEAN.format('service_type')} AS clean_type,
    {_brand('shoe_type', 'brand')} AS shoe_brand_clean, {_DISCOUNT.format('discount')} AS discount_type,
    total_price, nullif(trim(notes), '') AS notes, worker, data_source, is_synthetic,
    customer_name, shoe_type, service_type, price, discount, payment_status
  FROM raw_orders LEFT JOIN brand_names ON spelling = lower(shoe_type)
)"""
_STG_COLUMNS = (
    "order_no, order_date, year, month, week, customer_name_clean, payment_method, item_type, "
    "clean_type, shoe_brand_clean, discount_type, total_price, notes, worker, data_source, is_synthetic"
)

STG_EXPENSES = RAW_EXPENSES + """,
stg_expenses AS (
  SELECT expense_date, CAST(month(expense_date) AS INTEGER) AS month, item_name,
    CASE WHEN brand <> '' THEN brand END AS brand, unit_price, quantity, total_price,
    unit_price * quantity AS calculated_total_price, CASE WHEN notes <> '' THEN notes END AS notes,
    data_source, NOT (total_price = unit_price * quantity) AS is_total_price_mismatch,
    is_synthetic, is_date_imputed
  FROM raw_expenses
)"""

FCT_ORDERS = STAGED + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_name_clean, year
    ORDER BY order_date NULLS LAST, order_no NULLS LAST, price NULLS LAST, discount NULLS LAST,
      total_price NULLS LAST, shoe_type NULLS LAST, service_type NULLS LAST, worker NULLS LAST
  ) AS order_sequence_per_customer FROM staged
),
fct_orders AS (
  SELECT *, order_sequence_per_customer > 1 AS is_repeat_customer,
    CAST((1 - order_sequence_per_customer % 2) * 10000 AS INTEGER) AS expected_discount,
    CAST((1 - order_sequence_per_customer % 2) * 10000 - discount AS INTEGER) AS discount_gap,
    (1 - order_sequence_per_customer % 2) * 10000 > discount AS is_discount_missed
  FROM placed
)"""

EARNED = STAGED + """,
earned AS (
  SELECT *, coalesce(nullif(trim(payment_status), ''), 'unknown') AS payment_status_filled,
    nullif(trim(payment_status), '') IS NOT NULL AND coalesce(total_price > 0, FALSE) AS is_revenue,
    CASE WHEN nullif(trim(payment_status), '') IS NOT NULL AND total_price > 0
      THEN total_price ELSE 0 END AS net_revenue
  FROM staged
)"""

MONTHLY = STAGED + "," + STG_EXPENSES + f""",
revenue_month AS (
  SELECT year, month, count(*) AS orders, CAST(sum(total_price) AS BIGINT) AS revenue
  FROM staged GROUP BY year, month
),
expense_month AS (
  SELECT CAST(year(expense_date) AS INTEGER) AS year, month, count(*) AS purchases,
    CAST(sum(total_price) AS BIGINT) AS expenses
  FROM stg_expenses WHERE coalesce(lower(trim(brand)), '') <> 'gaji' GROUP BY 1, 2
),
salary AS (
  SELECT worker, year, month, CAST(sum(total_price) AS BIGINT) AS revenue,
    CAST(CAST(sum(total_price) AS DECIMAL(20, 0)) * {SHARE} AS DOUBLE) AS salary
  FROM staged GROUP BY ALL
),
salary_month AS (
  SELECT year, month, sum(salary) AS salary FROM salary GROUP BY year, month
),
profit AS (
  SELECT coalesce(r.year, e.year, s.year) AS year, coalesce(r.month, e.month, s.month) AS month,
    coalesce(revenue, 0) AS revenue, coalesce(expenses, 0) AS expenses,
    round(coalesce(salary, 0), 2) AS salary,
    round(coalesce(revenue, 0) - coalesce(expenses, 0) - coalesce(salary, 0), 2) AS profit
  FROM revenue_month r
  FULL JOIN expense_month e ON e.year IS NOT DISTINCT FROM r.year AND e.month IS NOT DISTINCT FROM r.month
  FULL JOIN salary_month s ON s.year IS NOT DISTINCT FROM coalesce(r.year, e.year)
    AND s.month IS NOT DISTINCT FROM coalesce(r.month, e.month)
)"""

_ORDER_ID = (
    "concat_ws('_', coalesce(CAST(year AS VARCHAR), 'none'), coalesce(CASE WHEN order_no < 0 THEN '-' ELSE '' END || "
    "CASE WHEN length(CAST(abs(order_no) AS VARCHAR)) < 4 "
    "THEN repeat('0', 4 - length(CAST(abs(order_no) AS VARCHAR))) || abs(order_no) ELSE CAST(abs(order_no) AS VARCHAR) END, 'none'), "
    "CASE WHEN n > 1 THEN CAST(n AS VARCHAR) END)"
)

_PRIME = 2147483647


def _draw(row_id: str, stream: int, n: str) -> str:
    """The generator's draw below n, written with 128-bit integers."""
    high = f"((({row_id}) // {_PRIME}) % {_PRIME}) * {69621 + stream}"
    step = f"((({row_id}) % {_PRIME}) * 48271 + {high} + {1013904223 + 97531 * stream}) % {_PRIME}"
    h = f"CAST({step} AS HUGEINT)"
    fifth = f"(({h} * {h}) % {_PRIME} * (({h} * {h}) % {_PRIME})) % {_PRIME} * {h} % {_PRIME}"
    return f"CAST(floor(CAST(({fifth}) * {n} AS DOUBLE) / {_PRIME}) AS INTEGER)"


SYNTH = f"""
rolled AS (
  SELECT o_orderkey AS id, DATE '2025-01-01' + {_draw('o_orderkey', 1, '469')} AS tanggal,
    {_draw('o_orderkey', 2, '100')} AS service_roll
  FROM orders
),
served AS (
  SELECT *, CASE WHEN service_roll < 86 THEN 'Deep Clean' WHEN service_roll < 94 THEN 'Fast Clean'
    WHEN service_roll < 97 THEN 'Tas' WHEN service_roll < 99 THEN 'Reparasi' ELSE 'Karpet' END AS cuci
  FROM rolled
),
price_lists(layanan, daftar) AS (
  VALUES ('Deep Clean', [40000, 45000, 50000, 60000, 65000]), ('Fast Clean', [35000]),
    ('Tas', [30000, 80000, 90000]), ('Reparasi', [40000, 50000]), ('Karpet', [30000, 40000])
),
synth AS (
  SELECT id, tanggal AS "Tanggal",
    (['Andi', 'Budi', 'Citra', 'Dewi', 'Eko', 'Fajar', 'Gita', 'Hana', 'Ivan', 'Julia', 'Kevin',
      'Lisa', 'Mario', 'Nadia', 'Oscar', 'Putri', 'Qori', 'Reza', 'Sari', 'Tono', 'Uma', 'Vino',
      'Wulan', 'Xena', 'Yogi', 'Zara', 'Alif', 'Bella', 'Chandra', 'Dina', 'Erwin', 'Fira', 'Galih',
      'Hesti', 'Imam', 'Joko', 'Karin', 'Lukman', 'Mita', 'Nando'])[{_draw('id', 6, '40')} + 1] AS "Nama",
    CASE WHEN cuci IN ('Tas', 'Karpet') THEN cuci ELSE
     (['Adidas', 'Nike', 'Vans', 'Skechers', 'Converse', 'Diadora', 'Onitsuka', 'On Cloud', 'NB',
      'Hoka', 'Puma', 'Warrior', 'UnderArmour', 'Compass', 'Reebok', 'Asics', 'Converse High',
      'Converse Allstar', 'Patrobas', 'Wakai', 'Zara', 'Aerostreet'])[{_draw('id', 5, '22')} + 1]
    END AS "Jenis Sepatu",
    cuci AS "Jenis cuci",
    daftar[{_draw('id', 3, 'len(daftar)')} + 1] AS "Harga",
    ([0, 0, 0, 5000, 10000])[{_draw('id', 4, '5')} + 1] AS "Discount",
    daftar[{_draw('id', 3, 'len(daftar)')} + 1] - ([0, 0, 0, 5000, 10000])[{_draw('id', 4, '5')} + 1]
      AS "Total harga",
    'Synthetic' AS "Keterangan", 'Paid' AS "Status Pembayaran",
    (['Vian', 'Amory', 'Rio'])[{_draw('id', 7, '3')} + 1] AS "Kang Cuci", TRUE AS is_synthetic
  FROM served JOIN price_lists ON layanan = cuci
)"""


def _typed_shape(names_types: list[tuple[str, str]], relation: str) -> str:
    rows = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(names_types))
    return (
        f"SELECT CAST(position AS INTEGER) AS position, column_name, data_type, "
        f"(SELECT count(*) FROM {relation}) AS row_count "
        f"FROM (VALUES {rows}) AS t(position, column_name, data_type)"
    )


_RAW_ORDER_TYPES = [
    ("order_no", "bigint"), ("order_date", "date"), ("customer_name", "string"),
    ("shoe_type", "string"), ("service_type", "string"), ("price", "int"), ("discount", "int"),
    ("total_price", "int"), ("notes", "string"), ("payment_status", "string"),
    ("worker", "string"), ("data_source", "string"), ("is_synthetic", "boolean"),
]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _price_row(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, min({c}) AS min, "
        f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
        f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM raw_orders"
    )


def _check(name: str, condition: str, relation: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(count(*) FILTER ({condition}) AS BIGINT) AS failing, "
        f"count(*) FILTER ({condition}) = 0 AS passed FROM {relation}"
    )


def _gate(position: int, name: str, condition: str, relation: str, is_rate: bool) -> str:
    rate = f"avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)"
    shown = f"CAST(round({rate}, 9) AS DOUBLE)" if is_rate else "CAST(NULL AS DOUBLE)"
    passed = f"coalesce({rate} <= 0.30, TRUE)" if is_rate else f"count(*) FILTER ({condition}) = 0"
    return (
        f"SELECT CAST({position} AS INTEGER) AS position, '{name}' AS check_name, "
        f"CAST(count(*) FILTER ({condition}) AS BIGINT) AS failing, {shown} AS rate, "
        f"{passed} AS passed FROM {relation}"
    )


def oracle_sql() -> dict[str, str]:
    with_ = lambda ctes, select: f"WITH {ctes.strip()}\n{select}"
    ot = lambda s: with_(ORDERS_TEXT, s)
    ro = lambda s: with_(RAW_ORDERS, s)
    et = lambda s: with_(EXPENSES_TEXT, s)
    re_ = lambda s: with_(RAW_EXPENSES, s)
    st = lambda s: with_(STAGED, s)
    fo = lambda s: with_(FCT_ORDERS, s)
    ne = lambda s: with_(EARNED, s)
    mo = lambda s: with_(MONTHLY, s)
    sy = lambda s: with_(SYNTH, s)

    order_text_columns = (
        "no AS order_no, tanggal AS order_date, nama AS customer_name, sepatu AS shoe_type, "
        "cuci AS service_type, harga AS price, diskon AS discount, total AS total_price, "
        "keterangan AS notes, status AS payment_status, pekerja AS worker"
    )
    odd_no = (
        "CASE k % 211 WHEN 5 THEN 'Jumlah' WHEN 6 THEN '' WHEN 7 THEN 'nan' "
        "WHEN 8 THEN no || '.0' ELSE no END"
    )
    summary = (
        "SELECT data_source, count(*) AS row_count, min({0}) AS earliest, max({0}) AS latest, "
        "round(avg(total_price), 6) AS avg_total_price FROM {1} GROUP BY data_source ORDER BY 1"
    )
    q = {}

    # scans, loads, projections, unions
    q["na_tokens_to_null"] = ot(
        f"SELECT no AS order_no, {_na('sepatu')} AS shoe_type, {_na('keterangan')} AS notes, "
        f"{_na('status')} AS payment_status FROM orders_text"
    )
    q["raw_orders_load"] = ro("SELECT * FROM raw_orders ORDER BY order_date, order_no")
    q["raw_expenses_load"] = re_("SELECT * FROM raw_expenses ORDER BY expense_date, item_name")
    q["orders_rename_project"] = ot(f"SELECT {order_text_columns} FROM orders_text")
    q["expenses_rename_project"] = et(
        "SELECT tanggal AS expense_date, barang AS item_name, merk AS brand, harga AS unit_price, "
        "jumlah AS quantity, total AS total_price, keterangan AS notes FROM expenses_text"
    )
    q["lenient_project"] = ot(
        "SELECT no AS order_no, tanggal AS order_date, nama AS customer_name, total AS total_price "
        "FROM orders_text"
    )
    q["enforce_schema"] = ot(
        "SELECT CAST(no AS BIGINT) AS order_no, CAST(NULL AS DATE) AS order_date, "
        "nama AS customer_name, sepatu AS shoe_type, cuci AS service_type, "
        "CAST(NULL AS INTEGER) AS price, CAST(NULL AS INTEGER) AS discount, "
        "CAST(NULL AS INTEGER) AS total_price, keterangan AS notes, "
        "CAST(NULL AS VARCHAR) AS payment_status, pekerja AS worker, data_source, is_synthetic "
        "FROM orders_text"
    )
    q["truncate_columns_after"] = ot(
        'SELECT no AS "No", tanggal AS "Tanggal", nama AS "Nama", sepatu AS "Jenis Sepatu", '
        'cuci AS "Jenis cuci", harga AS "Harga", diskon AS "Discount", total AS "Total harga", '
        'keterangan AS "Keterangan", status AS "Status Pembayaran", pekerja AS "Kang Cuci" '
        "FROM orders_text"
    )
    q["union_orders"] = ro("SELECT * FROM raw_orders")
    q["union_expenses"] = re_("SELECT * FROM raw_expenses")

    # filters
    q["filter_numeric_order_no"] = ot(
        f"SELECT CAST(TRY_CAST({odd_no} AS DOUBLE) AS BIGINT) AS order_no, {odd_no} AS order_no_text "
        f"FROM orders_text WHERE TRY_CAST({odd_no} AS DOUBLE) IS NOT NULL "
        f"AND NOT isnan(TRY_CAST({odd_no} AS DOUBLE))"
    )
    q["filter_null_dates"] = ro("SELECT * FROM raw_orders WHERE order_date IS NOT NULL")
    q["filter_placeholder_rows"] = ro(
        "SELECT * FROM raw_orders WHERE customer_name IS NOT NULL AND total_price > 0"
    )

    # cleaning functions
    q["rp_to_int"] = ot(
        f"SELECT no AS order_no, harga AS price_text, {_rp('harga')} AS price, diskon AS discount_text, "
        f"{_rp('diskon')} AS discount, {_rp('total')} AS total_price FROM orders_text"
    )
    q["indonesian_month"] = et(
        "SELECT keterangan AS notes, CAST(bulan_gaji AS INTEGER) AS month_number FROM expenses_dated"
    )
    q["parse_date_dayfirst"] = ot(
        f"SELECT no AS order_no, tanggal AS date_text, {_order_day('tanggal')} AS order_date FROM orders_text"
    )
    q["parse_date_multi"] = et(
        "SELECT tanggal AS date_text, own_day AS expense_date FROM expenses_dated"
    )
    q["safe_quantity"] = et(
        f"SELECT jumlah AS quantity_text, {_num('jumlah')} AS quantity FROM expenses_text"
    )
    q["impute_expense_date"] = et(
        "SELECT tanggal AS date_text, merk AS brand, keterangan AS notes, "
        "coalesce(own_day, payday) AS expense_date, "
        "own_day IS NULL AND payday IS NOT NULL AS is_date_imputed FROM expenses_dated"
    )
    q["coerce_fill_zero"] = et(
        "SELECT jumlah AS quantity_text, harga AS price_text, "
        "CAST(trunc(coalesce(TRY_CAST(jumlah AS DOUBLE), 0)) AS INTEGER) AS quantity, "
        "CAST(trunc(coalesce(TRY_CAST(harga AS DOUBLE), 0)) AS INTEGER) AS unit_price FROM expenses_text"
    )
    q["date_parts"] = ro(
        "SELECT order_no, order_date, CAST(extract(year FROM order_date) AS INTEGER) AS year, "
        "CAST(extract(month FROM order_date) AS INTEGER) AS month, "
        "CAST(extract(week FROM order_date) AS INTEGER) AS week FROM raw_orders"
    )
    q["week_start"] = ro(
        "SELECT order_no, order_date, CAST(date_trunc('week', order_date) AS DATE) AS week_start "
        "FROM raw_orders"
    )
    q["expense_blank_to_null"] = et(
        "SELECT merk AS brand_text, CASE WHEN merk <> '' THEN merk END AS brand, "
        "CASE WHEN keterangan <> '' THEN keterangan END AS notes FROM expenses_text"
    )
    q["notes_clean"] = ot(
        "SELECT no AS order_no, CASE WHEN trim(keterangan) <> '' THEN trim(keterangan) END AS notes "
        "FROM orders_text"
    )
    q["expense_calc_total"] = re_(
        "SELECT unit_price, quantity, quantity * unit_price AS calculated_total_price FROM raw_expenses"
    )
    q["expense_price_mismatch"] = re_(
        "SELECT unit_price, quantity, total_price, "
        "NOT (total_price = quantity * unit_price) AS is_total_price_mismatch FROM raw_expenses"
    )

    # staging rules, on the text as written (blank and null both occur)
    q["customer_name_clean"] = with_(
        ORDERS_TEXT,
        f"SELECT customer_name, {_NAME} AS customer_name_clean "
        "FROM (SELECT nama AS customer_name FROM orders_text)",
    )
    q["honorific_flag"] = ot(
        "SELECT nama AS customer_name, split_part(nama, ' ', 1) IN "
        "('Ka', 'Kak', 'Mas', 'Ko', 'Pak', 'Bang', 'Mama') AND strpos(nama, ' ') > 0 "
        "AS has_honorific FROM orders_text"
    )
    q["payment_method"] = ot(
        f"SELECT keterangan AS notes, {_PAYMENT.format('keterangan')} AS payment_method FROM orders_text"
    )
    q["item_type"] = ot(f"SELECT cuci AS service_type, {_ITEM.format('cuci')} AS item_type FROM orders_text")
    q["clean_type"] = ot(
        f"SELECT cuci AS service_type, {_CLEAN.format('cuci')} AS clean_type FROM orders_text"
    )
    q["shoe_brand"] = with_(
        ORDERS_TEXT + "," + _BRANDS,
        f"SELECT sepatu AS shoe_type, {_brand('sepatu', 'brand')} AS shoe_brand_clean "
        "FROM orders_text LEFT JOIN brand_names ON spelling = lower(sepatu)",
    )
    q["discount_type"] = ro(
        f"SELECT discount, {_DISCOUNT.format('discount')} AS discount_type FROM raw_orders"
    )
    q["stg_orders"] = st(f"SELECT {_STG_COLUMNS} FROM staged")
    q["stg_expenses"] = with_(STG_EXPENSES, "SELECT * FROM stg_expenses")
    q["staged_item_discount_summary"] = st(
        "SELECT item_type, discount_type, count(*) AS orders, CAST(sum(total_price) AS BIGINT) AS revenue "
        "FROM staged GROUP BY item_type, discount_type"
    )

    # profiling and summaries
    q["verify_orders"] = ro(summary.format("order_date", "raw_orders"))
    q["verify_expenses"] = re_(summary.format("expense_date", "raw_expenses"))
    q["profile_null_counts"] = ro(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM raw_orders"
            for c, _ in _RAW_ORDER_TYPES
        )
    )
    q["null_rate"] = ro(
        _union(
            f"SELECT '{c}' AS column_name, round(1.0 - count({c}) / count(*), 9) AS null_rate FROM raw_orders"
            for c in ("worker", "customer_name", "price")
        )
    )
    q["profile_price_stats"] = ro(_union(_price_row(c) for c in ("price", "total_price")))
    q["profile_shape"] = ro(_typed_shape(_RAW_ORDER_TYPES, "raw_orders"))
    q["value_counts_worker"] = ro(
        "SELECT worker, count(*) AS count FROM raw_orders WHERE worker IS NOT NULL "
        "GROUP BY worker ORDER BY count DESC, worker"
    )
    q["date_range"] = ro(
        "SELECT min(order_date) AS earliest, max(order_date) AS latest FROM raw_orders"
    )
    q["sample_head"] = ro(
        "SELECT * FROM raw_orders ORDER BY order_date, order_no, customer_name, total_price LIMIT 5"
    )
    q["sequence_number"] = ro(
        "SELECT row_number() OVER (ORDER BY order_date, order_no, price, total_price, shoe_type, "
        "service_type, notes) AS no, order_date, order_no, total_price, shoe_type FROM raw_orders"
    )

    # data quality
    q["dq_orders"] = ro(
        _union([
            _gate(0, "order_date_unparseable", "order_date IS NULL", "raw_orders", False),
            _gate(1, "total_price_negative", "total_price < 0", "raw_orders", False),
            _gate(2, "worker_null_rate", "worker IS NULL", "raw_orders", True),
        ])
    )
    q["dq_expenses"] = re_(
        _union([
            _gate(0, "quantity_negative", "quantity < 0", "raw_expenses", False),
            _gate(1, "total_price_negative", "total_price < 0", "raw_expenses", False),
            _gate(2, "item_name_null_rate", "item_name IS NULL", "raw_expenses", True),
        ])
    )
    filled = (
        "SELECT '{0}' AS ledger, '{1}' AS column_name, TRUE AS is_present, count({1}) AS filled_rows "
        "FROM raw_{0}"
    )
    q["dq_required_columns"] = with_(
        RAW_ORDERS + "," + RAW_EXPENSES,
        _union([
            *[
                filled.format("orders", c)
                for c in ("order_no", "order_date", "service_type", "total_price", "worker")
            ],
            *[filled.format("expenses", c) for c in ("item_name", "quantity", "total_price")],
        ]),
    )
    q["dq_not_null"] = st(
        _union([
            *[
                _check(f"not_null_{c}", f"{c} IS NULL", "staged")
                for c in ("order_no", "order_date", "customer_name_clean", "total_price")
            ],
            _check("not_null_payment_status", "payment_status IS NULL AND total_price > 0", "staged"),
        ])
    )
    q["dq_unique"] = ro(
        "SELECT 'unique_order_no' AS check_name, CAST(count(*) AS BIGINT) AS failing, "
        "count(*) = 0 AS passed FROM (SELECT order_no FROM raw_orders WHERE order_no IS NOT NULL "
        "GROUP BY order_no HAVING count(*) > 1)"
    )
    q["dq_accepted_values"] = st(
        _union([
            _check(
                "accepted_values_discount_type",
                "discount_type NOT IN ('none', 'loyalty', 'special', 'promo', 'manual', 'surcharge', 'unknown')",
                "staged",
            ),
            _check(
                "accepted_values_item_type", "item_type NOT IN ('sepatu', 'tas', 'karpet', 'sendal')", "staged"
            ),
            _check(
                "accepted_values_clean_type",
                "clean_type NOT IN ('deep clean', 'fast clean', 'reparasi')",
                "staged",
            ),
        ])
    )
    q["dq_discount_alert"] = fo(
        "SELECT year, count(*) AS missed_discounts FROM fct_orders WHERE is_discount_missed "
        "GROUP BY year HAVING count(*) > 3"
    )

    # facts and dimensions
    q["fct_orders"] = fo(
        f"SELECT {_STG_COLUMNS}, price, discount, order_sequence_per_customer, is_repeat_customer, "
        "expected_discount, discount_gap, is_discount_missed FROM fct_orders"
    )
    surrogate = (
        "SELECT order_no, order_date, year AS source_year, total_price, "
        f"{_ORDER_ID} AS order_id FROM ("
        "SELECT *, row_number() OVER (PARTITION BY year, order_no ORDER BY order_date NULLS LAST, "
        "customer_name_clean NULLS LAST, price NULLS LAST, discount NULLS LAST, total_price NULLS LAST, "
        "shoe_type NULLS LAST, service_type NULLS LAST, worker NULLS LAST) AS n FROM staged)"
    )
    q["order_surrogate_key"] = st(surrogate)
    q["dq_order_id_unique"] = st(
        "SELECT 'unique_order_id' AS check_name, CAST(count(*) AS BIGINT) AS failing, count(*) = 0 AS passed "
        f"FROM (SELECT order_id FROM ({surrogate}) GROUP BY order_id HAVING count(*) > 1)"
    )
    q["dq_order_id_not_null"] = st(_check("not_null_order_id", "order_id IS NULL", f"({surrogate})"))
    q["payment_status_filled"] = ne(
        "SELECT order_no, payment_status, total_price, payment_status_filled, is_revenue, net_revenue FROM earned"
    )
    q["net_monthly_revenue"] = ne(
        "SELECT year, month, count(*) AS orders, CAST(sum(net_revenue) AS BIGINT) AS revenue FROM earned GROUP BY ALL"
    )
    q["net_profit"] = with_(MONTHLY.replace("staged AS (", "staged_all AS (", 1).replace(
        ",\nrevenue_month AS (",
        """,
staged AS (
  SELECT * REPLACE (CASE WHEN nullif(trim(payment_status), '') IS NOT NULL AND total_price > 0
    THEN total_price ELSE 0 END AS total_price) FROM staged_all
),
revenue_month AS (""", 1), "SELECT * FROM profit")
    q["revenue_by_year"] = ne(
        "SELECT year, count(*) AS orders, CAST(sum(net_revenue) AS BIGINT) AS revenue FROM earned GROUP BY year"
    )
    q["worker_performance_in_year"] = ne(
        "SELECT worker, count(*) AS orders, CAST(sum(net_revenue) AS BIGINT) AS earnings FROM earned "
        "WHERE year = 1996 GROUP BY worker"
    )
    q["revenue_excluded_orders"] = ne(
        "SELECT year, CASE WHEN payment_status_filled = 'unknown' THEN 'unpaid' ELSE 'no_total' END AS reason, "
        "count(*) AS orders, CAST(sum(total_price) AS BIGINT) AS excluded FROM earned "
        "WHERE NOT is_revenue GROUP BY ALL"
    )
    q["dq_net_not_null"] = ne(
        _union([_check(f"not_null_{c}", f"{c} IS NULL", "earned") for c in ("net_revenue", "payment_status_filled", "is_revenue")])
    )
    q["fct_monthly_revenue"] = mo("SELECT * FROM revenue_month")
    q["fct_monthly_expenses"] = mo("SELECT * FROM expense_month")
    q["fct_salary"] = mo(
        "SELECT worker, year, month, revenue, salary, round(revenue - salary, 2) AS kas, "
        "make_date(year, month, 25) AS pay_date FROM salary"
    )
    q["fct_profit"] = mo("SELECT * FROM profit")
    q["net_margin"] = mo(
        "SELECT year, month, revenue, expenses, "
        "round(CASE WHEN revenue <> 0 THEN (revenue - expenses) / revenue END, 9) AS net_margin FROM profit"
    )
    q["fct_worker_performance"] = st(
        "SELECT worker, count(*) AS orders, CAST(sum(total_price) AS BIGINT) AS earnings FROM staged GROUP BY worker"
    )
    q["dim_customers"] = st(
        "SELECT customer_name_clean, count(*) AS total_orders, min(order_date) AS first_order_date, "
        "max(order_date) AS last_order_date FROM staged GROUP BY customer_name_clean"
    )
    q["dim_service_types"] = st(
        "SELECT service_type, count(*) AS orders, min(price) AS min_price, max(price) AS max_price, "
        "round(avg(price), 6) AS avg_price FROM staged GROUP BY service_type"
    )
    q["fct_expenses"] = with_(
        STG_EXPENSES,
        "SELECT CASE WHEN lower(trim(brand)) = 'gaji' THEN 'gaji' ELSE 'COGS' END AS category, "
        "count(*) AS purchases, CAST(sum(total_price) AS BIGINT) AS expenses FROM stg_expenses GROUP BY 1",
    )
    q["top_customers"] = st(
        "SELECT customer_name_clean, CAST(sum(total_price) AS BIGINT) AS revenue FROM staged "
        "GROUP BY customer_name_clean ORDER BY revenue DESC NULLS LAST, customer_name_clean NULLS LAST LIMIT 10"
    )
    q["repeat_rate"] = fo(
        "SELECT year, count(*) AS orders, round(count(*) FILTER (is_repeat_customer) / count(*), 9) "
        "AS repeat_rate FROM fct_orders GROUP BY year"
    )
    q["missed_discount_by_year"] = fo(
        "SELECT year, count(*) FILTER (is_discount_missed) AS missed_discounts FROM fct_orders GROUP BY year"
    )
    q["pricing_anomalies"] = st(
        "SELECT order_no, order_date, customer_name_clean, price, discount, total_price, "
        "CASE WHEN discount < 0 THEN 'surcharge' ELSE 'free_order' END AS anomaly "
        "FROM staged WHERE discount < 0 OR discount = price"
    )
    q["month_gaps"] = st(
        "SELECT m AS month_start, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM ("
        "SELECT CAST(unnest(generate_series(date_trunc('month', min(order_date)), "
        "date_trunc('month', max(order_date)), INTERVAL 1 MONTH)) AS DATE) AS m FROM staged) "
        "WHERE m NOT IN (SELECT CAST(date_trunc('month', order_date) AS DATE) FROM staged "
        "WHERE order_date IS NOT NULL)"
    )
    q["shoe_material"] = st(
        "SELECT order_no, shoe_brand_clean, coalesce(mat, 'Unknown') AS shoe_material, "
        "coalesce(cx, 'Unknown') AS material_complexity FROM staged LEFT JOIN (VALUES "
        "('Converse', 'Canvas', 'Low'), ('On Running', 'Mesh', 'Medium'), ('Nike', 'Leather', 'Medium'), "
        "('New Balance', 'Suede', 'High')) AS m(b, mat, cx) ON b = shoe_brand_clean"
    )

    # feeds read from files, date votes, ids that stay, touched periods
    q["csv_rejects"] = """
SELECT CASE WHEN k % 97 NOT IN (5, 6) THEN CAST(k AS VARCHAR) END AS order_no,
  CASE WHEN k % 97 NOT IN (5, 6) THEN day END AS date_text,
  CASE WHEN k % 97 NOT IN (5, 6) THEN buyer END AS customer,
  CASE k % 97 WHEN 5 THEN k || ',' || day WHEN 6 THEN k || ',' || day || ',' || buyer || ',extra' END AS reject_line,
  k % 97 IN (5, 6) AS is_rejected
FROM (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, 'Pelanggan ' || o_custkey AS buyer FROM orders)"""
    votes = EXPENSES_TEXT + """,
readings AS (
  SELECT data_source, tanggal,
    CAST(try_strptime(tanggal, '%m/%d/%Y') AS DATE) AS by_month, CAST(try_strptime(tanggal, '%d/%m/%Y') AS DATE) AS by_day,
    CAST(try_strptime(tanggal, '%Y-%m-%d') AS DATE) AS by_year
  FROM expenses_text
),
votes AS (
  SELECT data_source AS feed, count(*) FILTER (by_month IS NOT NULL AND by_day IS NULL) AS month_first,
    count(*) FILTER (by_day IS NOT NULL AND by_month IS NULL) AS day_first,
    count(*) FILTER (by_day <> by_month) AS ambiguous
  FROM readings GROUP BY data_source
),
elected AS (SELECT *, day_first > month_first AS is_day_first FROM votes)"""
    q["expense_date_vote"] = with_(
        votes,
        "SELECT feed, month_first, day_first, ambiguous, CASE WHEN is_day_first THEN 'd/M/yyyy' ELSE 'M/d/yyyy' END AS elected, "
        "least(month_first, day_first) AS contradicting FROM elected",
    )
    q["expense_dates_as_voted"] = with_(
        votes,
        "SELECT data_source, tanggal AS date_text, CASE WHEN is_day_first THEN coalesce(by_year, by_day, by_month) "
        "ELSE coalesce(by_year, by_month, by_day) END AS expense_date FROM readings JOIN elected ON feed = data_source",
    )
    q["stable_order_ids"] = st(
        surrogate.replace("ORDER BY order_date", "ORDER BY data_source = 'real_2023', order_date", 1)
    )
    q["touched_months"] = st("SELECT DISTINCT year, month FROM staged WHERE data_source = 'real_2023'")
    described = (
        "SELECT '{0}' AS column_name, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min, "
        "round(quantile_cont(x, 0.25), 4) AS p25, round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75, "
        "round(max(x), 4) AS max FROM (SELECT CAST({1} AS DOUBLE) AS x FROM customer)"
    )
    q["describe_any_number"] = _union([
        described.format("wide", "c_custkey * 3000000000 - 40000000000"),
        described.format("c_acctbal", "c_acctbal"),
        described.format("with_nan", "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 3 END"),
        described.format("exact", "CAST(c_acctbal AS DECIMAL(12, 2))"),
    ])

    # the checklist's rules and findings
    begins = lambda c: (
        f"CASE regexp_extract(lower(trim({c})), '^(deep|fast|reparasi|tas|karpet|sendal)') WHEN 'deep' THEN 'Deep Clean' "
        "WHEN 'fast' THEN 'Fast Clean' WHEN 'reparasi' THEN 'Reparasi' WHEN 'tas' THEN 'Tas' WHEN 'karpet' THEN 'Karpet' "
        "WHEN 'sendal' THEN 'Sendal' END"
    )
    q["service_category"] = ot(
        f"SELECT cuci AS service_type, sepatu AS shoe_type, coalesce({begins('cuci')}, {begins('sepatu')}) AS service_category, "
        f"coalesce({begins('sepatu')}, {begins('cuci')}) AS category_of_shoe_first FROM orders_text"
    )
    category = f"coalesce({begins('service_type')}, {begins('shoe_type')})"
    q["dq_service_category"] = st(
        _union([
            "SELECT 'accepted_values_service_category' AS check_name, CAST(0 AS BIGINT) AS failing, TRUE AS passed",
            _check("not_null_service_category", f"{category} IS NULL", "staged"),
        ])
    )
    q["checklist_payment_method"] = ot(
        "SELECT keterangan AS notes, CASE WHEN regexp_matches(keterangan, 'BCA|BLU') THEN 'Transfer' "
        "WHEN regexp_matches(keterangan, 'cash *$') THEN 'Cash' ELSE 'Unknown' END AS payment_method FROM orders_text"
    )
    item = lambda c: (
        f"CASE WHEN coalesce(trim({c}), '') = '' THEN 'Other' ELSE CASE regexp_extract(lower(trim({c})), '^(tas|karpet|sendal|reparasi)') "
        "WHEN 'tas' THEN 'Bag' WHEN 'karpet' THEN 'Carpet' WHEN 'sendal' THEN 'Sandal' WHEN 'reparasi' THEN 'Other' ELSE 'Shoe' END END"
    )
    q["checklist_item_type"] = ot(
        f"SELECT sepatu AS shoe_type, {item('sepatu')} AS item_type, cuci AS service_type, {item('cuci')} AS item_type_of_service FROM orders_text"
    )
    even = "order_sequence_per_customer % 2 = 0"
    q["loyalty_audit"] = fo(
        f"SELECT year, count(*) FILTER ({even} AND discount >= 10000) AS earned, "
        f"count(*) FILTER ({even} AND discount < 10000) AS missed, "
        f"count(*) FILTER (NOT ({even}) AND discount = 10000) AS unearned FROM fct_orders GROUP BY year"
    )
    q["unearned_loyalty"] = fo(
        "SELECT order_no, order_date, customer_name_clean, order_sequence_per_customer, discount, total_price "
        f"FROM fct_orders WHERE NOT ({even}) AND discount_type = 'loyalty'"
    )
    q["confined_discounts"] = st(
        "SELECT discount, any_value(year) AS year, any_value(month) AS month, count(*) AS orders FROM staged "
        "WHERE order_date IS NOT NULL AND discount > 0 GROUP BY discount "
        "HAVING count(DISTINCT year * 100 + month) = 1"
    )
    q["services_above"] = st(
        "SELECT c AS service_category, orders, round(a, 6) AS avg_price, m AS max_price, round(b, 6) AS base_price, a > b AS is_above FROM ("
        f"SELECT {category} AS c, count(*) AS orders, avg(price) AS a, max(price) AS m FROM staged GROUP BY 1) "
        f"CROSS JOIN (SELECT avg(price) AS b FROM staged WHERE {category} = 'Deep Clean')"
    )

    # synthetic feeds, one row per order key / schedule per part
    q["synth_orders"] = sy(
        'SELECT row_number() OVER (ORDER BY "Tanggal", id) AS "No", * EXCLUDE (id) FROM synth'
    )
    q["synth_service_mix"] = sy(
        'SELECT "Jenis cuci" AS service_type, count(*) AS orders, CAST(sum("Total harga") AS BIGINT) '
        "AS revenue FROM synth GROUP BY 1"
    )
    q["recurring_schedule"] = f"""
WITH plan AS (
  SELECT p_partkey, p_name, p_brand, CAST(floor(p_retailprice) AS INTEGER) AS price, p_size,
    ([1, 2, 3, 4, 6])[p_partkey % 5 + 1] AS every FROM part
),
due AS (
  SELECT *, unnest(range(0, 16, every)) AS months_on FROM plan
),
turns AS (
  SELECT *, CAST(DATE '2025-01-01' + to_months(CAST(months_on AS INTEGER)) AS DATE) AS due_date,
    p_partkey * 1021 + months_on // every AS seed FROM due
)
SELECT due_date + {_draw('seed', 8, '11')} AS "Tanggal", p_name AS "Nama Barang", p_brand AS "Merk",
  price AS "Harga", p_size AS "Jumlah", price * p_size AS "Total Harga", '' AS "Keterangan",
  TRUE AS is_synthetic FROM turns WHERE due_date <= DATE '2026-04-14'"""
    return q
