"""The cleaning rules as plain Python, for comparison in tests only."""

import re

NON_SPACE = r"[^ \t\n\x0b\f\r]"
ANY = r"[^\n\r\x85  ]"
BLANKS = "".join(map(chr, range(0x21)))

NOISE = re.compile(
    rf"#{NON_SPACE}+|https:{NON_SPACE}+|Tel{ANY} [0-9\-,]+|Tel{ANY}[0-9\-,]+"
    rf"|Email Address: {NON_SPACE}+|Email Address:{NON_SPACE}+|\n"
)
WEBSITE = re.compile(rf"www{ANY}{NON_SPACE}+\.com(\.cn)?")
SYMBOLS = re.compile(
    "[一-鿿]+|(?:[\U0001f300-\U0001f5ff‍\U0001f900-\U0001f9ff\U0001f600-\U0001f64f"
    "\U0001f680-\U0001f6ff]|[☀-⛿]️?|[✀-➿]️?|Ⓜ️?"
    "|[\U0001f1e6-\U0001f1ff]{1,2}"
    "|[\U0001f170\U0001f171\U0001f17e\U0001f17f\U0001f18e\U0001f191-\U0001f19a]️?"
    "|[#*0-9]️?⃣|[↔-↙↩-↪]️?"
    "|[⬅-⬇⬛⬜⭐⭕]️?|[⤴⤵]️?|[〰〽]️?"
    "|[㊗㊙]️?"
    "|[\U0001f201\U0001f202\U0001f21a\U0001f22f\U0001f232-\U0001f23a\U0001f250\U0001f251]️?"
    "|[‼⁉]️?|[▪▫▶◀◻-◾]️?|[©®]️?"
    "|[™ℹ]️?|\U0001f004️?|\U0001f0cf️?"
    "|[⌚⌛⌨⏏⏩-⏳⏸-⏺]️?)+"
)


def sentences(text):
    parts = text.split(".")
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    if parts == [""] and text:
        parts = []
    return [p.strip(BLANKS) + "." for p in parts]


def tidy(sentence):
    return ",".join(p for p in (q.strip(BLANKS) for q in sentence.split(",")) if p)


def gate(text):
    return text if 30 <= len(text.encode("utf-16-be", "surrogatepass")) // 2 <= 500 else ""


def strip_post(text):
    text = WEBSITE.sub("need etl website", SYMBOLS.sub("", NOISE.sub("", text)))
    text = text.replace("�", "")
    kept = [s for s in sentences(text) if "need etl website" not in s]
    text = "".join(map(tidy, kept))[:-1]
    return re.sub(" {2,}", " ", re.sub(r"\\u[A-Za-z0-9_]+", "", text))


def clean_post(text):
    return None if text is None else gate(strip_post(text))
