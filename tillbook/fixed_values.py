"""Values that must match the ledgers' own conventions for results to be right.

Header names, labels, word lists, thresholds and patterns live here and nowhere
else. They are data; the logic that uses them is in the other modules.
"""

# ---------------------------------------------------------------------------
# Feed headers (Indonesian) and the names they take on.
# ---------------------------------------------------------------------------
ORDER_HEADERS = {
    "No": "order_no",
    "Tanggal": "order_date",
    "Nama": "customer_name",
    "Jenis Sepatu": "shoe_type",
    "Jenis cuci": "service_type",
    "Harga": "price",
    "Discount": "discount",
    "Total harga": "total_price",
    "Keterangan": "notes",
    "Status Pembayaran": "payment_status",
    "Kang Cuci": "worker",
}

EXPENSE_HEADERS = {
    "Tanggal": "expense_date",
    "Nama Barang": "item_name",
    "Merk": "brand",
    "Harga": "unit_price",
    "Jumlah": "quantity",
    "Total Harga": "total_price",
    "Keterangan": "notes",
}

# ---------------------------------------------------------------------------
# The two warehouse tables.
# ---------------------------------------------------------------------------
RAW_ORDERS_SCHEMA = (
    "order_no bigint, order_date date, customer_name string, shoe_type string, "
    "service_type string, price int, discount int, total_price int, notes string, "
    "payment_status string, worker string, data_source string, is_synthetic boolean"
)

RAW_EXPENSES_SCHEMA = (
    "expense_date date, item_name string, brand string, unit_price int, quantity int, "
    "total_price int, notes string, data_source string, is_synthetic boolean, "
    "is_date_imputed boolean"
)

# ---------------------------------------------------------------------------
# Source labels.
# ---------------------------------------------------------------------------
REAL_2023 = "real_2023"
REAL_2025 = "real_2025"
SYNTHETIC_ORDERS = "synthetic_orders"
SYNTHETIC_SUPPLIES = "synthetic_supplies"

# ---------------------------------------------------------------------------
# Text that a CSV field may hold in place of "missing".
# ---------------------------------------------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---------------------------------------------------------------------------
# Date formats, month names, salary convention.
# ---------------------------------------------------------------------------
ORDER_DATE_FORMATS = ["d/M/yyyy", "yyyy-MM-dd[ HH:mm:ss]"]
EXPENSE_DATE_FORMATS = ["yyyy-MM-dd[ HH:mm:ss]", "M/d/yyyy", "d/M/yyyy"]

INDONESIAN_MONTHS = {
    "januari": 1, "februari": 2, "maret": 3, "april": 4, "mei": 5, "juni": 6,
    "juli": 7, "agustus": 8, "september": 9, "oktober": 10, "november": 11, "desember": 12,
}

SALARY_BRAND = "gaji"
SALARY_DAY = 25
SALARY_YEAR = 2023

# ---------------------------------------------------------------------------
# Staging vocabulary.
# ---------------------------------------------------------------------------
CUSTOMER_ALIASES = {"Kost no 12": "Pelanggan Kost 12", "Temen Putri": "Teman Putri"}
HONORIFIC_PATTERN = r"^(Ka|Kak|Mas|Ko|Pak|Bang|Mama)\s"

TRANSFER_MARK = "BCA"
CASH_SUFFIX = "cash"

NON_SHOE_SERVICES = ["tas", "karpet", "sendal"]
DEFAULT_ITEM = "sepatu"
SERVICE_PREFIXES = {"deep": "deep clean", "fast": "fast clean", "reparasi": "reparasi"}
NON_SHOE_CLEAN = "deep clean"

BRAND_SPELLINGS = {
    "On Running": ["on cloud", "cloud", "cloudtech", "cloud tec"],
    "New Balance": ["nb", "new balance"],
    "Unknown": ["gatau", "???", "lokal", ""],
}
BRAND_PREFIXES = {"nike": "Nike", "adidas": "Adidas", "converse": "Converse"}
UNKNOWN_BRAND = "Unknown"

DISCOUNT_LABELS = {0: "none", 5000: "special", 8000: "promo", 10000: "loyalty"}
LOYALTY_DISCOUNT = 10000
MANUAL_DISCOUNT_ABOVE = 10000
UNKNOWN_PAYMENT_STATUS = "unknown"
DISCOUNT_TYPES = ["none", "loyalty", "special", "promo", "manual", "surcharge", "unknown"]

# ---------------------------------------------------------------------------
# The checklist's vocabulary, beside the live rules above.
# ---------------------------------------------------------------------------
SERVICE_CATEGORIES = {
    "deep": "Deep Clean", "fast": "Fast Clean", "reparasi": "Reparasi",
    "tas": "Tas", "karpet": "Karpet", "sendal": "Sendal",
}
CHECKLIST_ITEMS = {"tas": "Bag", "karpet": "Carpet", "sendal": "Sandal", "reparasi": "Other"}
CHECKLIST_ITEM_TYPES = ["Shoe", "Bag", "Carpet", "Sandal", "Other"]
TRANSFER_MARKS = ["BCA", "BLU"]

# ---------------------------------------------------------------------------
# Data-quality rules.
# ---------------------------------------------------------------------------
REQUIRED_ORDER_COLUMNS = ["order_no", "order_date", "service_type", "total_price", "worker"]
REQUIRED_EXPENSE_COLUMNS = ["item_name", "quantity", "total_price"]
MAX_NULL_RATE = 0.30
MAX_MISSED_DISCOUNTS_PER_YEAR = 3

# ---------------------------------------------------------------------------
# The synthetic order mix.
# ---------------------------------------------------------------------------
SYNTH_SERVICE_PERCENT = {
    "Deep Clean": 86, "Fast Clean": 8, "Tas": 3, "Reparasi": 2, "Karpet": 1,
}
SYNTH_PRICES = {
    "Deep Clean": [40000, 45000, 50000, 60000, 65000],
    "Fast Clean": [35000],
    "Tas": [30000, 80000, 90000],
    "Reparasi": [40000, 50000],
    "Karpet": [30000, 40000],
}
SYNTH_DISCOUNTS = [0, 0, 0, 5000, 10000]
SYNTH_WORKERS = ["Vian", "Amory", "Rio"]
SYNTH_SHOES = [
    "Adidas", "Nike", "Vans", "Skechers", "Converse", "Diadora", "Onitsuka", "On Cloud",
    "NB", "Hoka", "Puma", "Warrior", "UnderArmour", "Compass", "Reebok", "Asics",
    "Converse High", "Converse Allstar", "Patrobas", "Wakai", "Zara", "Aerostreet",
]
SYNTH_CUSTOMERS = [
    "Andi", "Budi", "Citra", "Dewi", "Eko", "Fajar", "Gita", "Hana", "Ivan", "Julia",
    "Kevin", "Lisa", "Mario", "Nadia", "Oscar", "Putri", "Qori", "Reza", "Sari", "Tono",
    "Uma", "Vino", "Wulan", "Xena", "Yogi", "Zara", "Alif", "Bella", "Chandra", "Dina",
    "Erwin", "Fira", "Galih", "Hesti", "Imam", "Joko", "Karin", "Lukman", "Mita", "Nando",
]
SYNTH_NOTE = "Synthetic"
SYNTH_PAYMENT_STATUS = "Paid"
SUPPLY_JITTER_DAYS = 10
