"""What the tests on texts share."""

# Columns that the operators use inside, as extra columns of the input.
CLASHING = ["size", "counts", "kept", "key", "row", "ids", "score", "fingerprint", "root", "part", "block", "position", "doc"]
WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "tu", "so") for b in ("ra", "den", "fil", "gos", "hum", "ping", "t")]


def prose(rnd, n):
    return "".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", ".", ".\n"]) + " " for _ in range(n)).strip()
SCHEMA = "doc_id long, text string, lang string, source string"
