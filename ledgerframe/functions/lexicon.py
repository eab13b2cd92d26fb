"""Word lists of the commentary scorer.

Fixed values. The two-word entries cannot match a single token; they stay because
the lists must be these lists.
"""

POSITIVE = (
    "exceeded", "strong", "accelerated", "improved", "improvement", "ahead", "growth",
    "grew", "success", "successfully", "reduction", "reduced", "expansion", "notable",
    "solid", "meaningful", "outperform", "beat", "healthy", "efficient", "optimization",
    "increased", "gains", "positive", "record",
)
NEGATIVE = (
    "slipped", "delay", "delayed", "elevated", "attrition", "pressure", "pressured",
    "exceeded plan", "softened", "churn", "dispute", "unplanned", "freeze", "freezes",
    "slowdown", "risk", "miss", "missed", "shortfall", "decline", "declined", "concern",
    "concerns", "challenge", "challenges", "over budget", "overrun", "weak", "weakness",
)
NEGATIONS = ("not", "no", "without", "never")
