"""Fixed values the results depend on.

FIXED VALUES: these must stay exactly as written (names, ids, aliases, ranges,
rates, labels, brand lists, url rules, page-classifier phrases).  Everything
else in the package takes them as parameters, so callers can pass their own.
"""

# --- FIXED VALUES: categories (id, name, inclusive min price, inclusive max price) ---
CATEGORIES = [
    (1, "CPUs", 500.0, 35000.0),
    (2, "GPUs", 1000.0, 60000.0),
    (3, "RAM", 200.0, 15000.0),
    (4, "SSD", 300.0, 12000.0),
    (5, "Laptops", 5000.0, 80000.0),
    (6, "Monitores", 1500.0, 50000.0),
    (7, "Placas madre", 800.0, 20000.0),
]

# --- FIXED VALUES: stores (id, name, country, key, currency, base url) ---
STORES = [
    (1, "Mercado Libre", "México", "mercadolibre", "MXN", "https://listado.mercadolibre.com.mx"),
    (2, "AliExpress", "China", "aliexpress", "USD", "https://www.aliexpress.com"),
    (3, "Temu", "China", "temu", "USD", "https://www.temu.com"),
]

# --- FIXED VALUES: category aliases (lower-case alias -> canonical category name) ---
CATEGORY_ALIASES = {
    "cpu": "CPUs", "procesador": "CPUs", "processors": "CPUs",
    "gpu": "GPUs", "grafica": "GPUs", "graphics card": "GPUs",
    "ram": "RAM", "memoria ram": "RAM", "memory": "RAM",
    "ssd": "SSD", "disco solido": "SSD", "storage": "SSD",
    "laptop": "Laptops", "laptops": "Laptops", "notebook": "Laptops", "computadora": "Laptops",
    "monitor": "Monitores", "monitores": "Monitores", "display": "Monitores", "pantalla": "Monitores",
    "motherboard": "Placas madre", "placa madre": "Placas madre", "placas madre": "Placas madre",
    "mainboard": "Placas madre", "tarjeta madre": "Placas madre",
}

# --- FIXED VALUES: store aliases (lower-case alias -> canonical store name) ---
STORE_ALIASES = {
    "mercadolibre": "Mercado Libre", "mercado libre": "Mercado Libre",
    "mercado_libre": "Mercado Libre", "ml": "Mercado Libre",
    "aliexpress": "AliExpress", "ali_express": "AliExpress", "ae": "AliExpress",
    "temu": "Temu",
}

# --- FIXED VALUES: currency ---
USD_TO_MXN = 17.50
BASE_CURRENCY = "MXN"
SUPPORTED_CURRENCIES = ("USD", "MXN")

# --- FIXED VALUES: look-back defaults (days) ---
DEFAULT_DAYS = 30
WEEKDAY_DAYS = 90

# --- FIXED VALUES: ISO weekday labels, 1 = Monday .. 7 = Sunday ---
WEEKDAY_NAMES = {1: "Lunes", 2: "Martes", 3: "Miércoles", 4: "Jueves",
                 5: "Viernes", 6: "Sábado", 7: "Domingo"}

# --- FIXED VALUES: name cleaning ---
NAME_MAX_CHARS = 300            # cleaning truncation
LISTING_NAME_MAX = 300          # extraction side: longer names are cut to 297 + "..."
# kept code point ranges: printable ASCII, Latin-1 letters + Latin Extended-A/B, general punctuation
NAME_KEEP_RANGES = [(0x20, 0x7E), (0xC0, 0x24F), (0x2000, 0x206F)]

# --- FIXED VALUES: price text: currency markers removed in this order ---
PRICE_MARKERS = ["US$", "MX$", "USD", "MXN", "$", "€", "¥"]

# --- FIXED VALUES: ordered brand list per category (first match wins) ---
BRANDS = {
    "CPUs": ["AMD", "Intel", "Ryzen", "Core i", "Celeron", "Xeon"],
    "GPUs": ["NVIDIA", "AMD", "ASUS", "MSI", "Gigabyte", "EVGA", "Zotac", "PNY", "Sapphire", "XFX", "Colorful"],
    "RAM": ["Kingston", "Corsair", "Crucial", "G.Skill", "HyperX", "ADATA", "Patriot", "Team", "Samsung", "Lexar"],
    "SSD": ["Samsung", "Kingston", "WD", "Crucial", "Seagate", "ADATA", "SanDisk", "Lexar", "PNY", "Corsair"],
    "Laptops": ["Lenovo", "HP", "Dell", "ASUS", "Acer", "MSI", "Apple", "Huawei", "Toshiba", "LG", "Microsoft"],
    "Monitores": ["Samsung", "LG", "Dell", "ASUS", "Acer", "BenQ", "MSI", "HP", "ViewSonic", "AOC", "Gigabyte"],
    "Placas madre": ["ASUS", "MSI", "Gigabyte", "ASRock", "Biostar", "EVGA"],
}

# --- FIXED VALUES: search-page frontier per store ---
# (store key, url template, listings per page, max pages); {query} has spaces -> "-"
FRONTIER = [
    ("mercadolibre", "https://listado.mercadolibre.com.mx/{query}_Desde_{offset}_NoIndex_True", 48, 2),
    ("aliexpress", "https://www.aliexpress.com/w/wholesale-{query}.html?page={page}", 60, 2),
    ("temu", "https://www.temu.com/search_result.html?search_key={query}&page={page}", 40, 1),
]
# search text per (store key, category); a missing pair falls back to lower(category)
SEARCH_QUERIES = {
    "mercadolibre": {"CPUs": "procesador cpu", "GPUs": "tarjeta grafica gpu", "RAM": "memoria ram ddr4 ddr5",
                     "SSD": "disco solido ssd", "Laptops": "laptop computadora", "Monitores": "monitor pantalla",
                     "Placas madre": "tarjeta madre motherboard"},
    "aliexpress": {"CPUs": "cpu processor", "GPUs": "graphics card gpu", "RAM": "ddr4 ddr5 ram memory",
                   "SSD": "ssd solid state drive", "Laptops": "laptop notebook", "Monitores": "monitor display",
                   "Placas madre": "motherboard mainboard"},
    "temu": {"CPUs": "cpu processor", "GPUs": "graphics card", "RAM": "ram memory ddr5", "SSD": "ssd storage",
             "Laptops": "laptop computer", "Monitores": "computer monitor", "Placas madre": "motherboard"},
}
# offset rule of the first store: (page - 1) * 48 + 1
FRONTIER_OFFSET_STEP = 48

# --- FIXED VALUES: page and url rules of each store ---
# sku: (pattern, prefix) tried in order; item_url: an item url keeps this part only;
# tracking: query keys that go; keep_query: urls that hold this text keep their query,
# all others lose it; *_marks: page elements; captcha_both: a captcha phrase must stand in
# title and body; link: product links of a page without cards, link_cap: how many of them;
# per_page: listings per page, after which (times the pages) no further page is fetched
# (None: never stops)
STORE_RULES = {
    "mercadolibre": {
        "currency": "MXN", "sku": [(r"(MLM-[0-9]+)", "")], "item_url": None, "tracking": None, "keep_query": "/p/",
        "captcha_marks": ["div.captcha", "form#captcha"],
        "captcha_title": ["challenge", "captcha", "verificación", "verificacion"], "captcha_both": [],
        "challenge_marks": [], "challenge_title": [], "challenge_body": [], "blocked_body": [],
        "no_results_marks": ["div.ui-search-message"], "no_results_body": [],
        "link": r"/MLM-[0-9]+", "link_cap": None, "per_page": 48,
    },
    "aliexpress": {
        "currency": "USD", "sku": [(r"/item/([0-9]+)", "AE-")], "item_url": r"^(https?://[^/]+/item/[0-9]+\.html)",
        "tracking": ["alg", "spm", "scm", "pdp_ext_f", "pdp_npi", "sourceType", "source", "groupId", "traceId"], "keep_query": None,
        "captcha_marks": ["div.baxia-dialog", "div#nc_1_wrapper"], "captcha_title": [],
        "captcha_both": ["slide to verify", "verify you are human", "baxia", "captcha", "aliverify", "verificación de seguridad"],
        "challenge_marks": [], "challenge_title": [], "challenge_body": [], "blocked_body": [],
        "no_results_marks": ["div.no-result"], "no_results_body": [],
        "link": r"/item/", "link_cap": 60, "per_page": 60,
    },
    "temu": {
        "currency": "USD", "sku": [(r"-g-([0-9]+)", "TEMU-"), (r"/([0-9]{8,})\.html", "TEMU-")],
        "item_url": r"^(https?://[^/]+/[-A-Za-z0-9_]*-g-[0-9]+\.html)",
        "tracking": ["refer_page", "search_key", "search_meta", "sku_id", "ads", "page_el", "page_list", "obj_id", "obj_source",
                     "scene", "sub_scene", "mscene", "search_result", "pdp_id", "_bg_ref", "_x_share_id", "_x_sessn_id",
                     "src", "source", "channel"], "keep_query": None,
        "captcha_marks": ["div.captcha-verify", "div#captcha_verify_container", "iframe[src*='captcha']"],
        "captcha_title": [], "captcha_both": [],
        "challenge_marks": ["#challenge-running", "#challenge-stage", "#challenge-success", "#challenge-error",
                            "div.cf-browser-verification", "div#cf-challenge-running", "div#challenge-running",
                            "iframe[src*='challenges.cloudflare.com']", "form#challenge-form"],
        "challenge_title": ["just a moment", "attention required", "checking your browser", "verify you are human",
                            "cloudflare", "enable javascript", "sorry, you have been blocked"],
        "challenge_body": ["checking your browser before accessing", "please complete the security check",
                           "this process is automatic", "you have been blocked", "ray id",
                           "performance & security by cloudflare"],
        "blocked_body": ["your access has been restricted", "unusual activity detected", "access denied",
                         "ip has been blocked", "temporarily restricted"],
        "no_results_marks": ["div.empty-result"],
        "no_results_body": ["no results found", "0 results", "no items found", "couldn't find any matching",
                            "no se encontraron resultados"],
        "link": r"-g-", "link_cap": 40, "per_page": None,
    },
}

# --- FIXED VALUES: page drift threshold (relative length change) ---
DRIFT_THRESHOLD = 0.10

# --- FIXED VALUES: run log ---
RUN_STATUS_SUCCESS = "success"
RUN_STATUS_PARTIAL = "partial_success"
RUN_STATUS_FAILURE = "failure"
LOG_MESSAGE_MAX = 500
