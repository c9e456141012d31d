"""Every entry below has to be exactly this for results to match."""

# Page states, and the type codes of linked files.
PAGE_TYPES = ("FRONTIER", "CRAWLING", "HTML", "BINARY", "DUPLICATE")
DATA_TYPES = ("PDF", "BINARY", "DOC", "DOCX", "PPT", "PPTX")

# Response class by the first MIME fragment found (case-sensitive), in this order.
MIME_CLASSES = (
    ("text/html", "HTML"),
    ("application/pdf", "BINARY"),
    ("image/", "IMAGE"),
    ("video/", "VIDEO"),
)
MIME_UNKNOWN = "UNKNOWN"

# Type of a link by the suffix of its lower-cased URL; anything else is HTML.
SUFFIX_TYPES = (
    ((".html", ".htm", "robots.txt"), "HTML"),
    ((".pdf",), "PDF"),
    ((".jpg", ".jpeg", ".png"), "BINARY"),
    ((".doc",), "DOC"),
    ((".docx",), "DOCX"),
    ((".ppt",), "PPT"),
    ((".pptx",), "PPTX"),
)

# Links with exactly this text are dropped; these endings lose their last path part.
VOID_LINK = "javascript:void(0)"
INDEX_NAMES = ("index.html", "index.htm", "default.asp", "default.aspx")

# Marks of pages that need a browser: one case-sensitive, one in any case.
RENDER_MARK = "data-placeholder"
RENDER_MARK_ANY_CASE = "please enable javascript"

# Scoring, delay and stop defaults; all of them are parameters where they are used.
FOCUS_DOMAIN = "slo-tech.com"
KEYWORDS = ("novice", "forum", "clanki")
SEED_RELEVANCE = 3
DEFAULT_DELAY_SECONDS = 5.0
MAX_HTML_PAGES = 25_000
STOP_CHECK_EVERY = 10
SINGLE_INSERT_SITE_ID = 3
FAILED_FETCH_STATUS = 500
RETRIED_STATUSES = (500, 502, 503, 504)
IMAGE_CONTENT_TYPE = "image"

# Column length limits, by table.
LENGTH_LIMITS = {
    "data_type": {"code": 20},
    "page_type": {"code": 20},
    "site": {"domain": 500},
    "page": {"page_type_code": 20, "url": 3000, "accessed_ip": 16, "content_hash": 64},
    "page_data": {"data_type_code": 20},
    "image": {"filename": 255, "content_type": 50},
}

# XML namespace of sitemap files.
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
