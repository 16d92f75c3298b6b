"""Fixed values.

Everything in this module is a FIXED VALUE: word lists, patterns, maps,
factors and thresholds whose exact content decides the results, so they are
stated plainly and together here.  Patterns are written for Java regex
(Spark ``rlike`` / ``regexp_*``); ``(?iuU)`` gives Python-like Unicode
case folding, ``\\w``, ``\\s`` and ``\\b``.
"""

# --------------------------------------------------------------------------
# FIXED VALUES — cleaning
# --------------------------------------------------------------------------

# Category normalisation map (plural -> singular; singular maps to itself).
CATEGORY_MAP = {
    "laptops": "laptop",
    "gpus": "gpu",
    "phones": "phone",
    "laptop": "laptop",
    "gpu": "gpu",
    "phone": "phone",
}

# Availability patterns: the in-stock pattern is searched first.
IN_STOCK_PATTERN = r"(?iuU)\bin[_\s]?stock\b|verfügbar|lieferbar|available|lagernd"
OUT_OF_STOCK_PATTERN = r"(?iuU)\bout[_\s]?of[_\s]?stock\b|nicht verfügbar|ausverkauft|unavailable"
CANONICAL_AVAILABILITY = ("in_stock", "out_of_stock", "unknown")

# Name cleaning: HTML tag, hyphen family, characters kept, whitespace.
HTML_TAG_PATTERN = r"<[^>]+>"
HYPHEN_CHARS = "‐‑‒–—―−"
DROP_RUN_PATTERN = r"[^\p{L}\p{N}_\-.,\"/'()]+"

# Price text: first run of digits, dots and commas.
PRICE_TOKEN_PATTERN = r"[0-9.,]+"
NBSP = " "

# Anomaly factors around the category median (both strict comparisons).
ANOMALY_HIGH_FACTOR = 3.0
ANOMALY_LOW_FACTOR = 1.0 / 3.0

# --------------------------------------------------------------------------
# FIXED VALUES — matching
# --------------------------------------------------------------------------

RULE_THRESHOLD = 0.65
FUZZY_THRESHOLD = 85.0
VECTOR_THRESHOLD = 0.75
CATALOG_BUILD_FUZZY_THRESHOLD = 88.0
CATALOG_BUILD_VECTOR_THRESHOLD = 0.82

# Accessory denylist (word-bounded alternatives).
ACCESSORY_PATTERN = (
    r"(?iuU)\b("
    r"netzteil|ladegerät|ladekabel|ladebuchse|ladeadapter"
    r"|akku(?:versum)?|batterie|akku\s*pack"
    r"|kompatibel\s+mit"
    r"|schutzfolie|schutzglas|displayfolie|panzerfolie"
    r"|schutzhülle|tragetasche|laptoptasche|laptop\s*tasche"
    r"|displaydeckel|gehäusedeckel|gehäuse"
    r"|ersatzteil|ersatz\s*teil"
    r"|li[-\s]?pol|li[-\s]?ion"
    r"|bildschirmschutz"
    r"|hülle\b|tasche\b"
    r"|(\d+\s*w|\d+\s*watt)\s+netzteil"
    r"|lcd\s+(touch\s+)?screen\s+display"
    r")\b"
)
# Display-part pattern, kept exactly as published: it begins with a word
# boundary followed by "ildschirm", so it never matches "bildschirm".
DISPLAY_PART_PATTERN = (
    r"(?iusU)\bildschirm\b.{0,60}\b(deckel|displaydeckel|lcd|oled|panel|modul|cover)\b"
)
# The evidently intended variant, selectable with ``intended_display_part=True``.
DISPLAY_PART_PATTERN_INTENDED = (
    r"(?iusU)\bbildschirm\b.{0,60}\b(deckel|displaydeckel|lcd|oled|panel|modul|cover)\b"
)

# Rule matcher tokens: ASCII lowercase letters and digits.
TOKEN_PATTERN = r"([a-z0-9]+)"

# Embedding pre-processing: spec noise stripped from every query, plus a second
# pattern applied only for these categories.
SPEC_NOISE_PATTERN = (
    r"(?iuU)\b\d+\s*(?:gb|tb|mb)\b"
    r"|\b\d+\s*(?:mhz|ghz)\b"
    r"|\b\d+\s*hz\b"
    r"|\b\d+-?(?:core|zoll|inch)\b"
    r"|\b(?:mit|und|f[uü]r|aus|von|auf|des|der|die|das)\b"
    r"|\b(?:chip|kapazit\w{0,6}|qwertz)\b"
    r"|\b(?:deutsch|english|englisch)\b"
    r"|\bgeneral\w{0,3}berholt\b"
    r"|\b(?:ram|ssd|hdd|nvme|cpu|gpu)\b"
    r"|\b(?:4k|3k|2k|fhd|qhd|uhd|wqxga|wuxga)\b"
)
COMPONENT_NOISE_PATTERN = (
    r"(?iuU)\b(19|20)\d{2}\b"
    r"|\bintel(?:\s+core)?\b"
    r"|\bi[3579]-?\d{3,6}[a-z]{0,4}\b"
    r"|\bultra\s+\d+\b"
    r"|\b(?:nvidia|geforce|radeon)\b"
    r"|\b(?:rtx|gtx|rx)\s*\d+(?:\s*(?:ti|super|xt))?\b"
    r"|\b(?:amd|ryzen|threadripper)\b"
    r"|\bai\s+\d+\b"
    r"|\b(?:hx|hs)\s+\d{2,4}\b"
    r"|\b\d{3,5}[a-z]{1,3}\b"
    r"|\bgen\s+\d+\b"
    r"|\b(?:oled|amoled|ips)\b"
    r"|\b(?:snapdragon|dimensity|mediatek|exynos|kirin)\b"
    r"|\b\d+\s*gen\s*\d+\b"
    r"|\b(?:retina|display|liquid)\b"
)
COMPONENT_NOISE_CATEGORIES = ("laptop", "phone")
MULTI_SPACE_PATTERN = r"(?U)\s{2,}"

# --------------------------------------------------------------------------
# FIXED VALUES — labelled matching test set
# --------------------------------------------------------------------------

TEST_SET_PER_CATEGORY = 15
TEST_SET_SEED = 42
NOISY_EN_SUFFIX = " 16GB RAM 512GB SSD"
NOISY_DE_PREFIX = "2024 "
NOISY_DE_SUFFIX = " mit 16GB RAM 512GB SSD QWERTZ Deutsch Generalüberholt"
SWEEP_THRESHOLDS = (60, 65, 70, 75, 80, 85, 90, 95)

# Accessory negatives (query, category): must never match a product.
ACCESSORY_NEGATIVES = [
    ("Apple 96W USB-C Netzteil kompatibel mit MacBook Pro 14 Zoll", "laptop"),
    ("Schutzfolie kompatibel mit MacBook Air 13 Retina Display", "laptop"),
    ("Laptoptasche 15.6 Zoll wasserabweisend schwarz mit Trolleyband", "laptop"),
    ("Akku-Pack 65W Li-Ion Ersatz kompatibel mit Lenovo ThinkPad E590", "laptop"),
    ("LCD Touch Screen Display Deckel Bildschirmdeckel 14 Zoll Ersatzteil", "laptop"),
    ("65W Netzteil Ladegerät USB-C kompatibel mit Dell XPS 13 15", "laptop"),
    ("Bildschirmdeckel Gehäusedeckel ASUS VivoBook 15 Ersatzteil", "laptop"),
    ("Li-Pol Akku Versum kompatibel mit Apple MacBook Air 2019 A1932", "laptop"),
    ("Bildschirmschutz Panzerglas Universal 15.6 Zoll Laptop", "laptop"),
    ("Ladekabel USB-C 90W kompatibel mit Lenovo IdeaPad ThinkPad", "laptop"),
    ("GPU Netzteil Kabel PCIe 8-Pin kompatibel mit NVIDIA RTX 4090", "gpu"),
    ("Ersatzteil Lüfter kompatibel mit NVIDIA GeForce RTX 3080 Founders", "gpu"),
    ("Netzteil 850W 80Plus Gold modular kompatibel mit AMD Radeon RX 7900 XT", "gpu"),
    ("Schutzglas kompatibel mit iPhone 15 Pro Max Displayschutz 9H", "phone"),
    ("Schutzhülle kompatibel mit Samsung Galaxy S24 Ultra Silikon Schwarz", "phone"),
    ("Ladekabel USB-C 2m kompatibel mit Samsung Galaxy schnellladung", "phone"),
    ("Schnellladegerät 45W USB-C Ladegerät kompatibel mit Apple iPhone 15 Pro", "phone"),
    ("Hülle kompatibel mit Google Pixel 8 Pro Stoßfest transparent", "phone"),
    ("Displayfolie Samsung Galaxy S24 FE Anti-Fingerprint schutzfolie Matt", "phone"),
    ("Panzerfolie kompatibel mit Apple iPhone 14 Pro Max 9H Echtglas", "phone"),
]

# --------------------------------------------------------------------------
# FIXED VALUES — collection side
# --------------------------------------------------------------------------

DEFAULT_CURRENCY = "EUR"
# Raw sources read by default (one more source exists but is not listed).
DEFAULT_RAW_SOURCES = ("google_shopping", "idealo_de_serpapi", "ebay_de", "amazon_de")
RAW_FILE_NAME = "products.json"

# Search-API results.
SHOPPING_DEFAULT_SELLER = "Google Shopping"
ORGANIC_SELLER = "Idealo DE (via Google)"
ORGANIC_DOMAIN = "idealo"
PRICE_PREFIX_PATTERN = r"(?i)^(ab|from)\s*"
SNIPPET_PRICE_PATTERN = r"(?:ab\s*)?([0-9.,]+)\s*(?:€|EUR)"
TITLE_SUFFIX_PATTERN = r"\s*\|.*$"

# Blocked-page test: short page containing the challenge marker.
BLOCKED_PAGE_MAX_LEN = 10000
BLOCKED_PAGE_MARKER = "Something has gone wrong"

# Relevance window for model extraction: indicators in list order.
WINDOW_INDICATORS = ("€", "EUR", " CHF", "Price")
WINDOW_BACKOFF = 200
WINDOW_CHARS = 5000

# Model token cost, USD per million tokens (input, output).
INPUT_COST_PER_M = 0.59
OUTPUT_COST_PER_M = 0.79
CODE_FENCE_PATTERN = r"```(?:json)?|```"

# Run report.
STATUS_ERROR_CHARS = 40
STATUS_ELLIPSIS = "…"
