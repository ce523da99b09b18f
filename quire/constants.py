"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as written for results to match the behaviour
this engine reproduces (limits, key lists, URL rule patterns, registry). Everything else
in the package is built from them.
"""

from __future__ import annotations

# ---------------------------------------------------------------- limits (FIXED VALUES)
MIN_ARTICLE_TEXT_LENGTH = 250      # verdict / content gate
LOW_QUALITY_TEXT_LENGTH = 200      # generic path: shorter normalized text becomes NULL
SUMMARY_MAX_CHARS = 512            # summary cut before "..."
SUMMARY_SENTENCES = 5              # first five sentences
MAX_FOLLOW_PER_PAGE = 100          # accepted links followed per discovery page
DEPTH_LIMIT = 50                   # crawl walk depth
FINGERPRINT_TEXT_CHARS = 2000      # text prefix inside the content fingerprint
NAV_JUNK_MIN_LINES = 10            # nav-junk rule: more than 10 lines ...
NAV_JUNK_SHORT_LINE = 30           # ... of which lines shorter than 30 chars ...
NAV_JUNK_SHARE = 0.7               # ... make up more than 70 %
LOW_CONFIDENCE = 0.50              # verdict: confidence below this is an error
MAX_ERRORS_IN_VERDICT = 3          # first three extractor errors joined by "; "
SUMMARY_FALLBACK_MIN = 50          # generic path: supplied summary used if >= 50 chars
QUALITY_SAMPLE = 50                # quality report sample size (CLI default)

# ------------------------------------------------- tracking query keys (FIXED VALUES)
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id",
    "utm_source_platform", "utm_creative_format", "utm_marketing_tactic",
    "gclid", "gclsrc", "dclid", "fbclid", "msclkid", "twclid", "igshid",
    "mc_cid", "mc_eid", "ref", "referer", "referrer", "source",
    "_ga", "_gl", "_hsenc", "_hsmi", "trk", "trkInfo",
]

# ------------------------------------------ URL rule patterns, generic (FIXED VALUES)
# Section / list page paths rejected before any accept rule (matched on lower(path)).
SECTION_DENY_PATTERNS = [
    r"^/news/?$", r"^/world/?$", r"^/business/?$", r"^/markets/?$", r"^/technology/?$",
    r"^/politics/?$", r"^/opinion/?$", r"^/latest/?$", r"^/us/?$", r"^/uk/?$",
    r"^/sport/?$", r"^/sports/?$", r"^/entertainment/?$", r"^/lifestyle/?$", r"^/health/?$",
    r"^/science/?$", r"^/section/", r"^/hub/", r"^/topics?/", r"^/tag/", r"^/category/",
    r"^/author/", r"^/search", r"^/video/?$", r"^/videos/?$", r"^/live/?$",
    r"^/podcasts?/?$", r"^/?$",
]
FEED_PATTERNS = ["rss", "feed", "sitemap", "atom"]

# Page-level article indicators of the generic page test.
ARTICLE_BODY_CLASSES = ["article-body", "article-content", "story-body", "post-content"]
LD_ARTICLE_TYPES = ["NewsArticle", "Article"]

# Promo paragraph filters.
FOX_PROMO_PREFIX = "WATCH:"
FOX_MIN_PARAGRAPH = 20
FOX_CAPS_MAX = 100
NBC_MIN_PARAGRAPH = 25
NBC_PROMO_PHRASES = ["sign up", "subscribe", "click here", "read more"]

# ------------------------------------------------------ source registry (FIXED VALUES)
# name, domain, allowed domains, seed pages, rule set.
SOURCES = [
    ("apnews", "apnews.com", ["apnews.com", "www.apnews.com"], [
        "https://apnews.com",
        "https://apnews.com/politics",
        "https://apnews.com/world-news",
        "https://apnews.com/business",
        "https://apnews.com/technology",
        "https://apnews.com/us-news",
    ], "ap"),
    ("bbc", "bbc.com", ["bbc.com", "www.bbc.com"], [
        "https://www.bbc.com/news",
        "https://www.bbc.com/news/world",
        "https://www.bbc.com/news/technology",
        "https://www.bbc.com/news/business",
        "https://www.bbc.com/news/science_and_environment",
    ], "bbc"),
    ("cbsnews", "cbsnews.com", ["cbsnews.com", "www.cbsnews.com"], [
        "https://www.cbsnews.com",
        "https://www.cbsnews.com/us",
        "https://www.cbsnews.com/world",
        "https://www.cbsnews.com/politics",
        "https://www.cbsnews.com/moneywatch",
    ], "cbs"),
    ("cnn", "cnn.com", ["cnn.com", "www.cnn.com"], [
        "https://www.cnn.com",
        "https://www.cnn.com/politics",
        "https://www.cnn.com/business",
        "https://www.cnn.com/world",
        "https://www.cnn.com/us",
        "https://www.cnn.com/health",
        "https://www.cnn.com/entertainment",
    ], "cnn"),
    ("foxnews", "foxnews.com", ["foxnews.com", "www.foxnews.com"], [
        "https://www.foxnews.com",
        "https://www.foxnews.com/politics",
        "https://www.foxnews.com/us",
        "https://www.foxnews.com/world",
        "https://www.foxnews.com/media",
    ], "fox"),
    ("guardian", "theguardian.com", ["theguardian.com", "www.theguardian.com"], [
        "https://www.theguardian.com/international",
        "https://www.theguardian.com/world",
        "https://www.theguardian.com/technology",
        "https://www.theguardian.com/business",
        "https://www.theguardian.com/politics",
        "https://www.theguardian.com/us-news",
    ], "guardian"),
    ("nbcnews", "nbcnews.com", ["nbcnews.com", "www.nbcnews.com"], [
        "https://www.nbcnews.com",
        "https://www.nbcnews.com/politics",
        "https://www.nbcnews.com/world",
        "https://www.nbcnews.com/business",
        "https://www.nbcnews.com/tech-media",
    ], "nbc"),
]

RULE_SETS = ["ap", "bbc", "cbs", "cnn", "fox", "guardian", "nbc", "generic"]

# ------------------------------------------- per-site URL rules (FIXED VALUES)
# (rule set, reject patterns, accept patterns). Each pattern is
# (kind, regex, case_insensitive) with kind "match" (anchored at the start of the URL)
# or "search" (anywhere). A URL is rejected on any reject hit, else accepted on any accept hit.
SITE_URL_RULES = {
    "ap": (
        [("match", r"https?://[^/]+/(hub/|politics/?$|world-news/?$|business/?$|technology/?$|us-news/?$)", True)],
        [("search", r"/article/", False)],
    ),
    "bbc": (
        [("search", r"/(av|live|programmes|newsround)/", True)],
        [("search", r"/news/[a-z]+-\d{6,}", True),
         ("search", r"/articles/[a-z0-9]+", True),
         ("search", r"/sport/articles/[a-z0-9]+", True)],
    ),
    "cbs": (
        [("match", r"https?://[^/]+/(us|world|politics|moneywatch|entertainment|business)/?$", True),
         ("match", r"https?://[^/]+/news/?$", True),
         ("search", r"/(video|live|essentials)/", True)],
        [("search", r"/news/[^/]+/?$", True)],
    ),
    "cnn": (
        [("search", r"/(video|gallery|live-news|cnn-underscored)/", True)],
        [("search", r"/\d{4}/\d{2}/\d{2}/", False)],
    ),
    "fox": (
        [("match", r"https?://[^/]+/(politics|us|world|media|opinion)/?$", True),
         ("search", r"/(video|category|shows|person)/", True)],
        [("search", r"/(politics|us|world|media|opinion|entertainment|tech)/[a-z0-9-]{20,}", True)],
    ),
    "guardian": (
        [("match", r"https?://[^/]+/(world|uk|us|technology|business|politics)/?$", True),
         ("search", r"/(video|gallery|live)/", True)],
        [("search", r"/\d{4}/[a-z]{3}/\d{2}/", True)],
    ),
    "nbc": (
        [("match", r"https?://[^/]+/(politics|world|business|tech-media|health|us-news)/?$", True),
         ("search", r"/(video|shows|now)/", True)],
        [("search", r"-rcna\d{4,}$", True), ("search", r"-n\d{6,}$", True)],
    ),
}

# Confidence ladders: (rule set) -> list of (needs, body_gt, score), first match wins,
# then the cap. "needs" names the parts that must be present: ld / ldbody / title / author / body.
CONFIDENCE_LADDERS = {
    "ap": ([(("ld", "body"), 500, 0.95), (("ld", "body"), None, 0.90),
            (("body",), 500, 0.80), (("body",), None, 0.75)], 0.50, None),
    "bbc": ([(("body", "title"), 500, 0.90), (("body", "title"), 300, 0.85),
             (("body", "title"), None, 0.75)], 0.60, 0.90),
    "cbs": ([(("ldbody", "body", "title"), None, 1.0), (("body", "title", "author"), 500, 0.85),
             (("body", "title"), 500, 0.83), (("body", "title"), None, 0.75)], 0.60, None),
    "cnn": ([(("body", "title", "author"), 500, 0.85), (("body", "title"), 500, 0.83),
             (("body", "title"), None, 0.75)], 0.60, None),
    "fox": ([(("body", "title"), 500, 0.75), (("body", "title"), 300, 0.70),
             (("body", "title"), None, 0.65)], 0.50, 0.75),
    "guardian": ([(("body", "title", "author"), 500, 0.90), (("body", "title"), 500, 0.88),
                  (("body", "title"), None, 0.80)], 0.65, None),
    "nbc": ([(("body", "title", "author"), 500, 0.80), (("body", "title"), 500, 0.78),
             (("body", "title"), None, 0.70)], 0.60, None),
}

# Output labels (FIXED VALUES): extraction method of the generic path and of a failed
# extractor; author provenance values.
METHOD_GENERIC = "newspaper3k"
METHOD_FAILED = "extractor"
AUTHOR_FEED = "feed"
AUTHOR_META = "meta"
AUTHOR_MISSING = "missing"

# Error strings (FIXED VALUES).
ERR_NO_PARAGRAPHS = "No article body paragraphs found"
ERR_LOW_CONFIDENCE = "Low confidence: missing critical content"
ERR_AP_NO_TITLE = "Title not found in JSON-LD or DOM"
ERR_NO_TITLE = "Title not found"
ERR_CBS_NO_LD = "JSON-LD not found"
ERR_CNN_NO_LD = "JSON-LD not found, using DOM extraction only"
ERR_GUARDIAN_NO_LD = "JSON-LD not found (unusual for Guardian)"
VERDICT_NO_TITLE = "No title extracted"
VERDICT_TEXT_SHORT = "Text too short or missing: {n} < {min}"
VERDICT_LOW_CONF = "Low extraction confidence: {c}"
GENERIC_GATE_FAILED = "Content validation failed (too short or invalid)"
EXTRACTOR_FAILED = "Extractor failed: "
PARSE_FAILED = "Parse failed: "

# FIXED VALUES: elements whose paragraphs are an article's text, as (tag or any, attribute, value);
# "class" means one of the class names, other attributes are compared whole.
ANCESTOR_RULES = {
    "article": ("article", None, None),
    "ap_body": (None, "class", "RichTextStoryBody"),
    "bbc_body": ("div", "data-component", "text-block"),
    "cbs_body": (None, "class", "content__body"),
    "fox_body": (None, "class", "article-body"),
    "guardian_body": ("div", "itemprop", "articleBody"),
}
