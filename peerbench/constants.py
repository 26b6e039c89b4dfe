"""Words, labels and tables that input and output formats depend on."""

# --- Fixed values: sheet-name keywords that mark a sheet as holding entities. ---
ENTITY_SHEET_WORDS = (
    "equity", "key", "revenue", "profitability", "financial", "growth", "figures",
)

# --- Fixed values: sheet-name keywords that mark a sheet as holding metrics. ---
METRIC_SHEET_WORDS = (
    "equity", "key", "figures", "data", "working", "capital", "stability", "cashflow",
)

# --- Fixed values: words that make a cell above the header usable as a column name. ---
SUPERHEADER_WORDS = (
    "ISIN", "FLOAT", "FREE", "MARKET", "CURRENCY", "P/E", "P/B", "ROE", "ROA",
    "EBIT", "EBITDA",
)

# --- Fixed values: texts inside a cell that stand for a failed lookup. ---
ERROR_TOKENS = (
    "THE RECORD COULD NOT BE FOUND", "ERROR CODE: 0", "NO DATA AVAILABLE",
    "DATA NOT AVAILABLE", "N/A", "#N/A", "#ERROR", "NULL",
)

# --- Fixed values: texts that mean "no value" in a request. ---
NULL_TOKENS = ("", "nan", "none")

# --- Fixed values: header names. ---
ID_HEADER = "RIC"
NAME_HEADERS = ("holding", "universe")

# --- Fixed values: column labels of the request sheet. ---
LABEL_SUB_INDUSTRY = "Sub-Industry"
LABEL_FOCUS = "Focus"
LABEL_SECTOR = "GICS Sector"
LABEL_SHEET_FIELDS = "Kennzahlen aus Excel"
LABEL_VENDOR_FIELDS = "Kennzahlen aus Refinitiv"

# --- Fixed values: prefix of a vendor field, flag mark, shortest name looked up. ---
VENDOR_PREFIX = "TR."
FLAG_MARK = "X"
MIN_NAME_LENGTH = 4

# --- Fixed values: sector name -> sector code. ---
SECTOR_CODES = (
    ("Consumer Discretionary", "25"),
    ("Consumer Staples", "30"),
    ("Energy", "10"),
    ("Financials", "40"),
    ("Health Care", "35"),
    ("Industrials", "20"),
    ("Information Technology", "45"),
    ("Materials", "15"),
    ("Real Estate", "60"),
    ("Communication Services", "50"),
    ("Utilities", "55"),
)

# --- Fixed values: proxy instruments per sector, in the order they are tried. ---
SECTOR_PROXIES = {
    "Consumer Discretionary": (".SPCD", "XLY", ".DJU5340", "IYC"),
    "Consumer Staples": (".SPCS", "XLP", ".DJU5350", "XLP"),
    "Information Technology": (".SPIT", "XLK", ".DJU9530", "IGV"),
    "Health Care": (".SPHC", "XLV", ".DJU4530", "IHI"),
    "Materials": (".SPMT", "XLB", ".DJU1510", "VAW"),
    "Energy": (".SPEN", "XLE", ".DJU1010", "VDE"),
    "Financials": (".SPFN", "XLF", ".DJU4010", "VFH"),
    "Industrials": (".SPIN", "XLI", ".DJU2010", "VIS"),
    "Utilities": (".SPUT", "XLU", ".DJU5510", "VPU"),
    "Real Estate": (".SPRE", "XLRE", ".DJU6010", "VNQ"),
    "Communication Services": (".SPCM", "XLC", ".DJU5010", "VOX"),
}

# --- Fixed values: words in a file name -> sector; the first line that fits wins. ---
# Each line: sector, words of which one must occur, words of which all must
# occur, words that must not occur.
FILE_SECTORS = (
    ("Consumer Discretionary", (), ("Consumer",), ("Basic",)),
    ("Consumer Staples", (), ("Basic", "Consumer"), ()),
    ("Health Care", ("Health",), (), ()),
    ("Information Technology", ("IT", "Technology"), (), ()),
    ("Materials", ("Materials",), (), ()),
    ("Real Estate", ("Housing",), (), ()),
    ("Utilities", ("Utilities",), (), ()),
    ("Energy", ("Energy",), (), ()),
    ("Financials", ("Financial", "Bank"), (), ()),
    ("Industrials", ("Industrial", "Manufacturing"), (), ()),
    ("Communication Services", ("Communication", "Telecom", "Media"), (), ()),
)

# --- Fixed values: requested sector word -> patterns for file names (any case). ---
SECTOR_FILE_PATTERNS = {
    "consumer": (r"^Consumer_.*\.xlsx$", r"^Basic.*Consumer.*\.xlsx$"),
    "materials": (r"^Materials_.*\.xlsx$",),
    "health": (r"^Health.*\.xlsx$",),
    "it": (r"^IT.*\.xlsx$", r"^.*Technology.*\.xlsx$"),
    "technology": (r"^IT.*\.xlsx$", r"^.*Technology.*\.xlsx$"),
    "utilities": (r"^Utilities.*\.xlsx$",),
    "housing": (r"^Housing.*\.xlsx$",),
}

# --- Fixed values: code rewrite applied to every cell. ---
CODE_MAP = (("RL", "RL.N"),)

# --- Fixed values: smallest and largest text width per report column. ---
COLUMN_WIDTHS = {
    "name": (25, 40),
    "id": (12, 15),
    "sub_industry": (15, 25),
    "focus": (15, 25),
    "sector": (15, 25),
}
METRIC_WIDTH = (12, 18)
OTHER_WIDTH = (10, 30)

# --- Fixed values: labels of benchmark rows in the report. ---
MEAN_MARK = "Ø "
ROW_MARKS = {"sub_industry_mean": "💼 ", "focus_mean": "🎯 ", "sector_mean": "🏭 "}
FOCUS_MEAN_TYPE = "Focus-Durchschnitt"
SECTOR_MEAN_TYPE = "GICS-Sektor-Durchschnitt"
FOCUS_MEAN_ROW = "Focus-Ø (%d Unternehmen)"
SECTOR_MEAN_ROW = "GICS-Sektor-Ø (Refinitiv-Branchendurchschnitt)"
REQUEST_ROW = "Zeile %d"
NO_SECTOR_TITLE = "Multi-Sector"

# --- Fixed values: cell texts that spreadsheet readers commonly take as empty. ---
EMPTY_CELL_TEXTS = frozenset((
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
))
