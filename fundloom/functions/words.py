"""Fixed values the rules depend on: word lists, lookup tables, thresholds. Nothing here is logic."""

# fixed values: sentiment word lists (matched as substrings, each counted once)
POSITIVE_LONG = ["good", "bull", "growth", "buy", "up", "high", "positive", "gain", "profit", "recommend", "great",
                 "best", "benefit", "outperform", "bullish", "strong"]
NEGATIVE_LONG = ["bad", "bear", "loss", "sell", "down", "low", "negative", "drop", "risk", "panic", "crash", "fall",
                 "pause", "drawdown", "bearish", "weak"]
POSITIVE_SHORT = ["good", "bull", "growth", "buy", "up", "positive", "gain", "profit", "strong"]
NEGATIVE_SHORT = ["bad", "bear", "loss", "sell", "down", "negative", "drop", "risk", "crash", "weak"]

# fixed values: impact words and the sectors they move
IMPACT_POSITIVE = ["growth", "beat", "upgrade", "cut", "support", "stable", "record", "surge", "strong", "bullish",
                   "ease"]
IMPACT_NEGATIVE = ["hike", "slowdown", "miss", "downgrade", "stress", "inflation", "crash", "selloff", "weak",
                   "bearish", "tighten"]
SECTOR_KEYWORDS = {
    "Banking": ["repo", "rate hike", "rate cut", "rbi", "gdp", "liquidity", "banks", "banking"],
    "Debt": ["repo", "rate hike", "inflation", "bond", "yield", "debt", "gilt"],
    "Energy": ["oil", "crude", "energy", "brent", "diesel", "petrol"],
    "FMCG": ["inflation", "demand", "rural", "consumption", "fmcg"],
    "IT": ["usd", "dollar", "it spending", "software", "tech", "recession"],
    "Mid Cap": ["mid cap", "mid-cap", "broadening", "growth", "domestic"],
    "Large Cap": ["gdp", "blue chip", "large cap", "stability", "earnings"],
    "Metals": ["china", "commodities", "metals", "steel", "aluminum"],
}

# fixed values: signal sentiment and impact labels
SIGNAL_UP = ["positive", "bullish", "up", "positive sentiment"]
SIGNAL_DOWN = ["negative", "bearish", "down", "critical", "high"]
IMPACT_UP = ["positive", "bullish"]
IMPACT_DOWN = ["negative", "bearish", "critical", "high"]

# fixed values: fund categories -> beta, base risk
CATEGORY_BETA = {"equity": 1.1, "mid_cap": 1.3, "small_cap": 1.5, "debt": 0.1, "liquid": 0.05, "hybrid": 0.6,
                 "balanced": 0.7, "index": 1.0}
CATEGORY_RISK = {"equity": 70.0, "mid_cap": 80.0, "small_cap": 90.0, "debt": 30.0, "liquid": 10.0, "hybrid": 50.0,
                 "balanced": 55.0, "index": 65.0}
EQUITY_CATEGORIES = ["equity", "mid_cap", "small_cap"]

# fixed values: persona -> risk multiplier, (low, medium, high) score limits
PERSONA_MULTIPLIER = {"conservative": 1.5, "balanced": 1.0, "growth": 0.8, "passive": 0.9}
PERSONA_LIMITS = {"conservative": (30, 50, 70), "balanced": (40, 60, 80), "growth": (50, 70, 85),
                  "passive": (35, 55, 75)}

# fixed values: catalogue grouping, tested in this order; then risk, base rating and base 1/3/5-year returns
FUND_GROUPS = [
    ("conservative", ["liquid", "overnight", "money market", "short duration", "ultra short", "corporate bond",
                      "gilt"]),
    ("passive", ["index", "nifty", "etf", "passive"]),
    ("balanced", ["balanced", "hybrid", "multi asset", "dynamic asset"]),
    ("growth", ["mid cap", "small cap", "sectoral", "thematic", "flexi", "large & mid"]),
]
GROUP_RISK = {"conservative": "low", "passive": "medium", "balanced": "medium", "growth": "high"}
GROUP_RATING = {"conservative": 4, "passive": 4, "balanced": 4, "growth": 5}
GROUP_RETURNS = {"conservative": (6.6, 6.2, 5.8), "passive": (11.8, 13.2, 12.6), "balanced": (15.4, 14.3, 13.5),
                 "growth": (24.8, 19.5, 17.2)}
PERSONA_GROUPS = {"growth": ["growth"], "balanced": ["balanced", "passive"], "passive": ["passive", "balanced"],
                  "conservative": ["conservative"]}

# fixed values: suitability classes (fund categories -> rating, label), tested in this order
SUITABILITY = [
    (["small-cap", "small cap", "sectoral", "thematic", "equity-high"], 90.0, "high"),
    (["mid-cap", "mid cap", "flexi-cap", "flexi cap", "elss", "equity"], 65.0, "medium-high"),
    (["index", "large-cap", "large cap", "hybrid", "balanced"], 45.0, "medium"),
    (["debt", "liquid", "gilt"], 15.0, "low"),
]
SUITABILITY_OTHER = (50.0, "medium")

# fixed values: client risk level -> funds to offer instead; the last entry serves every other level
SUITABLE_FUNDS = [
    (["conservative"], ["HDFC Liquid Fund", "ICICI Prudential Savings Fund", "UTI Nifty 50 Index Fund"]),
    (["balanced", "moderate"], ["SBI Equity Hybrid Fund", "UTI Nifty 50 Index Fund", "Mirae Asset Large Cap Fund"]),
    ([], ["Parag Parikh Flexi Cap Fund", "Mirae Asset Large Cap Fund", "Axis Small Cap Fund"]),
]

# fixed values: behavioural rule personas -> risk tolerance
RULE_PERSONA_RISK = {
    "Cluster 0: Aggressive Growth": "High Risk",
    "Cluster 1: Liquid Needers": "Low Risk",
    "Cluster 2: Brand Loyalists": "Medium Risk",
    "Cluster 3: Conservative Preservers": "Low Risk",
}

# fixed values: survey persona order (earlier wins a tie)
SURVEY_ORDER = ["growth", "conservative", "balanced", "passive"]

# fixed values: distributors offered when none is matched (name, score, fund type)
FALLBACK_DISTRIBUTORS = [
    ("NJ IndiaInvest Pvt Ltd (National Distributor)", 0.95, "Equity & High Growth Funds"),
    ("Prudent Corporate Advisory Services Ltd", 0.88, "Balanced & Hybrid Funds"),
    ("State Bank of India (Wealth)", 0.82, "Debt & Low Volatility Funds"),
    ("Zerodha Fund House / Coin", 0.79, "Index & Passive Funds"),
]

# fixed values: cluster id -> fund type, distributor; the last row is the fallback
CLUSTER_ROUTES = [
    (0, "Equity & High Growth Funds", "NJ IndiaInvest Pvt Ltd (National Distributor)"),
    (1, "Liquid & Debt Preservation", "State Bank of India (Wealth)"),
    (2, "Hybrid & Asset Allocation", "Prudent Corporate Advisory Services Ltd"),
    (None, "Index & Passive Smart-Beta", "Zerodha Fund House / Coin"),
]

# fixed values: chat routing terms; intents are tested in this order
INVESTOR_TERMS = ["sip", "mutual fund", "portfolio", "risk", "retirement", "tax", "invest", "lumpsum"]
DISTRIBUTOR_TERMS = ["lead", "objection", "arn", "amfi", "compliance", "nism", "call script", "pitch"]
INTENTS = [
    ("compliance", ["compliance", "sebi", "amfi", "kyc", "disclosure", "suitability"]),
    ("objection", ["objection", "risk", "volatility", "safe", "panic"]),
    ("lead_management", ["lead", "crm", "follow up", "hot lead", "warm lead"]),
    ("sip", ["sip", "systematic investment plan"]),
    ("tax", ["tax", "elss", "80c"]),
    ("portfolio", ["portfolio", "asset allocation", "diversification", "rebalance"]),
    ("fund_selection", ["best fund", "fund type", "recommend fund", "equity", "debt", "hybrid", "liquid"]),
    ("market_timing", ["buy now", "should i invest", "lumpsum", "market timing", "now", "small cap", "right now"]),
]
SCREEN_TERMS = ["graph", "graphs", "chart", "charts", "screen", "explain", "what does", "show me", "what is shown",
                "numbers", "on screen", "display", "visible", "what are these", "describe", "interpret",
                "analysis shown", "dashboard", "kpi", "metrics", "frontier", "radar", "benchmark", "allocation"]

# fixed values: lead model inputs
LEAD_NUMERIC = ["totalvisits", "total_time_spent_on_website", "page_views_per_visit", "asymmetrique_activity_score",
                "asymmetrique_profile_score"]
LEAD_CATEGORICAL = ["lead_origin", "lead_source", "specialization", "what_is_your_current_occupation",
                    "last_activity", "country", "lead_quality", "do_not_email", "do_not_call"]
TRAITS = ["ProfManage", "Diversification", "Affordability", "Liquidity", "Growth", "Trustworthiness", "Technology"]
