"""Fixed values of the retail rules: thresholds, word lists, prices and names.

Everything here is a default argument somewhere else, so a caller can bring a
table of their own.
"""

# Names of the values every stage agrees on.
DUPLICATE = "DUPLICATE_TRANSACTION_ID"
ERROR_FLAG = "ERROR_FLAG_IN_ADDINFO"
NULL_FIELD = "NULL_CRITICAL_FIELD"
BAD_DATE = "UNPARSEABLE_DATE"
NEGATIVE = "NEGATIVE_QUANTITY"
BAD_QUANTITY = "UNPARSEABLE_QUANTITY"
ZERO = "ZERO_QUANTITY"
UNKNOWN_REASON = "UNKNOWN"

ANOMALY = "Anomaly"
INVALID = "Invalid Data"
RESTOCK = "Restock"
SAFE = "Safe"
SHRINKAGE = "Shrinkage"
OVERCOUNT = "POS_Overcount"
NOT_APPLICABLE = "N/A"

INVALID_NOTE = "Menu_ID tidak terdaftar di BOM/Master_Inventory"
NO_RECIPE_NOTE = "Item tanpa resep BOM; stok movement tidak bisa dijelaskan POS"

UNKNOWN_EMPLOYEE = "UNKNOWN"

ANOMALY_LIMIT = 1000.0
FALLBACK_THRESHOLD = 20000.0
NO_CARTON_UNITS = "NO_CARTON_UNITS"
UNKNOWN_UNIT = "UNKNOWN_UNIT"

# Text that counts as missing in the sales file, and what a dimension file adds
# to it (the usual default missing-value marks of CSV readers).
SALES_NULLS = ("nan", "NaN", "NULL", "None", "none", "", "null")
DIMENSION_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
QUANTITY_BLANKS = ("", "nan", "none", "null", "nil", "-")

# An Additional_Info text that starts like one of these marks a broken sale.
ERROR_PREFIXES = (
    "err", "error", "eror", "#value", "#ref!", "undefined", "invalid",
    "inv4lid", "roer",
)

# Indonesian and English number words.
NUMBER_WORDS = {
    "satu": 1, "dua": 2, "tiga": 3, "empat": 4, "lima": 5, "enam": 6,
    "tujuh": 7, "delapan": 8, "sembilan": 9, "sepuluh": 10, "nol": 0, "nul": 0,
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9, "ten": 10, "zero": 0, "nil": 0,
}

MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
)

# Stock keeping units per supplier unit; "Karton" goes by item (CARTON_UNITS).
UNIT_FACTORS = {"Kilogram": 1000.0, "Liter": 1000.0, "Pcs": 1.0}
CARTON = "Karton"

# Pieces or millilitres in one carton, by item.
CARTON_UNITS = {
    "INV-0007": 4440, "INV-0017": 100, "INV-0018": 100, "INV-0022": 7920,
    "INV-0025": 50, "INV-0026": 50, "INV-0027": 50, "INV-0028": 50,
    "INV-0029": 50, "INV-0030": 50, "INV-0031": 50, "INV-0032": 250,
    "INV-0033": 250, "INV-0034": 200, "INV-0035": 20, "INV-0036": 20,
    "INV-0037": 20, "INV-0038": 24, "INV-0039": 20,
}

# Estimated price in rupiah of one gram, millilitre or piece, by item.
UNIT_COSTS = {
    "INV-0001": 280, "INV-0002": 140, "INV-0003": 320, "INV-0004": 25,
    "INV-0005": 80, "INV-0006": 95, "INV-0007": 15, "INV-0008": 85,
    "INV-0009": 90, "INV-0010": 90, "INV-0011": 90, "INV-0012": 100,
    "INV-0013": 90, "INV-0014": 350, "INV-0015": 280, "INV-0016": 18,
    "INV-0017": 250, "INV-0018": 280, "INV-0019": 12, "INV-0020": 30,
    "INV-0021": 65, "INV-0022": 20, "INV-0023": 12, "INV-0024": 2,
    "INV-0025": 1000, "INV-0026": 1100, "INV-0027": 1200, "INV-0028": 1300,
    "INV-0029": 500, "INV-0030": 550, "INV-0031": 600, "INV-0032": 140,
    "INV-0033": 180, "INV-0034": 200, "INV-0035": 15000, "INV-0036": 18000,
    "INV-0037": 12000, "INV-0038": 10000, "INV-0039": 5000, "INV-0040": 25000,
    "INV-0041": 8000, "INV-0042": 45,
}

# Items on the shelf list that no recipe uses.
NO_RECIPE_ITEMS = (
    "INV-0002", "INV-0003", "INV-0005", "INV-0006", "INV-0007", "INV-0018",
    "INV-0023", "INV-0027",
)

# What a rejected sale may still be worth: reason, class, chance of recovery.
TRIAGE = (
    (ERROR_FLAG, "PARTIAL_ERROR", "MEDIUM"),
    (NEGATIVE, "REFUND_TRANSACTION", "HIGH"),
    (ZERO, "VOID_TRANSACTION", "MEDIUM"),
    (DUPLICATE, "EXACT_DUPLICATE", "LOW"),
    (NULL_FIELD, "UNRECOVERABLE", "NONE"),
    (BAD_DATE, "UNRECOVERABLE", "NONE"),
    (BAD_QUANTITY, "UNRECOVERABLE", "NONE"),
)

# Spelling classes of dates in the source audit, in the order in which they apply.
DATE_CLASSES = (
    "ISO YYYY-MM-DD HH:MM:SS", "DD/MM/YYYY", "Month DD YYYY", "Compact 12-digit", "MM-DD-YYYY AM/PM",
)
