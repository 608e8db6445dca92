"""Constants whose exact text decides the result.

Everything in this module is data, not logic.  The cleaning rules, the lookup
codes and the reply literal are compared byte for byte with data produced by
other systems, so none of them may be "improved".
"""

# -- fixed values: noise tokens deleted from a post, leftmost alternative first
NOISE_TOKENS = (
    r"#\S+",
    r"https:\S+",
    r"Tel. [0-9\-,]+",
    r"Tel.[0-9\-,]+",
    r"Email Address: \S+",
    r"Email Address:\S+",
)
NEWLINE = r"\n"

# -- fixed values: web addresses.  The full profile marks them (the sentence
# around the mark is dropped later), the basic profile deletes them.
WEBSITE = r"www.\S+\.com(?:\.cn)?"
WEBSITE_BASIC = r"www.\S+\.com\.cn?"
WEBSITE_MARK = "need etl website"

# -- fixed values: literal unicode escapes, with the word run behind them
UNICODE_ESCAPE = r"\\u\w+"
REPLACEMENT_CHAR = "\ufffd"

# -- fixed values: accepted post length in UTF-16 units, both ends included
MIN_POST_UNITS = 30
MAX_POST_UNITS = 500

# -- fixed values: code points deleted as ideographs and emoji
CJK_IDEOGRAPHS = ((0x4E00, 0x9FFF),)
ZERO_WIDTH_JOINER = ((0x200D, 0x200D),)
# never followed by a variation selector
EMOJI_PLAIN = (
    (0x1F300, 0x1F5FF),
    (0x1F900, 0x1F9FF),
    (0x1F600, 0x1F64F),
    (0x1F680, 0x1F6FF),
    (0x1F1E6, 0x1F1FF),
)
# deleted together with one variation selector behind them
EMOJI_SELECTABLE = (
    (0x2600, 0x26FF),
    (0x2700, 0x27BF),
    (0x24C2, 0x24C2),
    (0x1F170, 0x1F171),
    (0x1F17E, 0x1F17F),
    (0x1F18E, 0x1F18E),
    (0x1F191, 0x1F19A),
    (0x2194, 0x2199),
    (0x21A9, 0x21AA),
    (0x2B05, 0x2B07),
    (0x2B1B, 0x2B1C),
    (0x2B50, 0x2B50),
    (0x2B55, 0x2B55),
    (0x2934, 0x2935),
    (0x3030, 0x3030),
    (0x303D, 0x303D),
    (0x3297, 0x3297),
    (0x3299, 0x3299),
    (0x1F201, 0x1F202),
    (0x1F21A, 0x1F21A),
    (0x1F22F, 0x1F22F),
    (0x1F232, 0x1F23A),
    (0x1F250, 0x1F251),
    (0x203C, 0x203C),
    (0x2049, 0x2049),
    (0x25AA, 0x25AB),
    (0x25B6, 0x25B6),
    (0x25C0, 0x25C0),
    (0x25FB, 0x25FE),
    (0x00A9, 0x00A9),
    (0x00AE, 0x00AE),
    (0x2122, 0x2122),
    (0x2139, 0x2139),
    (0x1F004, 0x1F004),
    (0x1F0CF, 0x1F0CF),
    (0x231A, 0x231B),
    (0x2328, 0x2328),
    (0x23CF, 0x23CF),
    (0x23E9, 0x23F3),
    (0x23F8, 0x23FA),
)
KEYCAP_BASE = "[#*0-9]"
VARIATION_SELECTOR = 0xFE0F
KEYCAP = 0x20E3

# -- fixed values: second-level industry codes of interest
INDUSTRY_WHITELIST = ("0", "75", "907", "230", "847", "449", "36", "757", "745")

# -- fixed values: message literal of a successful classifier reply
REPLY_SUCCESS = "成功"

# -- fixed values: cell table and message field names
CELL_FAMILY = "info"
POST_FIELDS = (
    "rowkey",
    "type",
    "post_user_name",
    "post_content",
    "dw_gofish_media_id",
    "media",
)
TIMED_RECORD_CELLS = {"name": "adid", "age": "adname", "time": "dn"}
INDUSTRY_FIELDS = ("industry_1", "industry_2", "industry_3")

# -- fixed values: event-time bounds
OUT_OF_ORDERNESS_MS = 2500
ALLOWED_LATENESS_MS = 1
CHECKPOINT_SECONDS = 60
