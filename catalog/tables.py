"""Rule and keyword tables whose words occur in the supplied, invented texts."""

RULES = (
    ("ACCOUNT_SECURITY", True, (r"\bvon\b", r"\bthin\b")),
    ("BILLING_PAYMENT", True, (r"\bque\b", r"\btion(s)?\b")),
    ("ACCOUNT_LOGIN", True, (r"\bwith\b", r"\bfrom\b")),
    ("SUBSCRIPTION_PREMIUM", False, (r"\bthe\b",)),
    ("PLAYBACK", True, (r"\bthis\b", r"\bder\b")),
    ("APP_TECHNICAL", True, (r"\bthat\b", r"\bin the\b", r"\bla\b")),
)

KEYWORDS = {
    "ACCOUNT_LOGIN": ["the", "tion", "ou", "with"],
    "PLAYBACK": ["this", "zzz", "und", "ing"],
    "APP_TECHNICAL": ["that", "qqq", "xxx", "la "],
    "OTHER": [],
}

# Frequent words of the English texts, taken out before the keyword report.
STOP_WORDS = ("the", "of", "and", "in", "to", "is", "that", "was", "for", "on", "it", "by", "as", "with", "be")
