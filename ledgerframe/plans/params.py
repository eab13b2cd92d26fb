"""Planning parameters of the registered queries, shared with their SQL counterparts."""

from datetime import date

AS_OF = date(2001, 6, 1)
HORIZON = 6
# target year: growth of revenue and of opex over the year before
BUDGET_GROWTH = {
    1996: {"Revenue": 0.05, "Opex": 0.04},
    1997: {"Revenue": 0.06, "Opex": 0.045},
    1998: {"Revenue": 0.035, "Opex": 0.05},
    1999: {"Revenue": 0.07, "Opex": 0.03},
    2000: {"Revenue": 0.045, "Opex": 0.025},
    2001: {"Revenue": 0.025, "Opex": 0.02},
}
RUN_RATE_GROWTH = {"Revenue": 0.004, "Opex": 0.0025}
LRP_BASE_YEAR = 2001
LRP_GROWTH = ((2002, 0.06, 0.05), (2003, 0.055, 0.04), (2004, 0.05, 0.045))
FILTER_YEARS = (1996, 1997)
FILTER_SEGMENTS = ("ECONOMY", "PROMO")
MIX_YEARS = (1999, 2000)
WHATIF_ARPU_PCT = 5
WHATIF_CHURN_PP = -2.0
SERVICES_RATE = 0.11
COMPANY_MIX = (("North", 0.48), ("South", 0.27), ("East", 0.25))
OPENING_CUSTOMERS = 0.0
ORPHAN_ACCOUNT = "610000"
HOLDOUT = 6
# the reference's counts, as models.TREES
FOREST_TREES = 300
BOOSTING_ROUNDS = 250
# postings missing from the ledger on purpose, so that the tie-out finds something
LEDGER_GAP = (date(1997, 3, 1), "400200")
# recursion with given coefficients, in the order of the feature columns
FIXED_INTERCEPT = 1000.0
FIXED_COEFFICIENTS = (2.0, 1.5, -3.0, 0.4, 0.1, 0.05, 0.2, 0.15, 0.1)
# the test documents are invented prose, so the scorer gets words that occur in it
TONE_POSITIVE = ("for", "with", "from", "the", "die", "les")
TONE_NEGATIVE = ("was", "are", "that", "und", "que")
TONE_NEGATIONS = ("no", "by", "un", "von")
TONE_DEPARTMENTS = ("Urgent desk", "High desk", "Low desk")
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "as",
    "by", "this", "are", "at", "from", "or", "an",
    "de", "la", "le", "les", "des", "du", "et", "un", "une", "que", "en", "au",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "auf",
    "el", "los", "del", "se", "es",
)
MAX_FEATURES = 200
