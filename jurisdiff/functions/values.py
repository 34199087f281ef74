"""Fixed values of the data model: enumerations, label maps, word lists."""

from __future__ import annotations

# Fixed values; the order of each list is significant where it ranks.
STATUS_ORDER = ["proposed", "draft", "consultation", "enacted", "in_force"]
AXES = ["risk_classification", "prohibited_uses", "gpai_obligations", "transparency", "penalties", "enforcement_body"]
UPDATE_AXES = [*AXES, "timeline", "general"]
CHANGE_TYPES = ["new_regulation", "status_change", "guideline_draft", "deadline_change", "diff_change", "other"]
APPROACHES = ["risk_based", "sectoral", "soft_law"]
DIFF_KEYS = ["stricter", "looser", "absent", "unique"]
RUN_STATUS = ["ok", "partial", "failed"]

# Labels.
AXIS_LABELS = {"risk_classification": "リスク分類", "prohibited_uses": "禁止用途", "gpai_obligations": "汎用AI義務", "transparency": "透明性", "penalties": "罰則", "enforcement_body": "執行体制", "timeline": "タイムライン", "general": "全般"}
STATUS_LABELS = {"proposed": "提案", "draft": "ドラフト", "consultation": "意見募集", "enacted": "成立", "in_force": "施行中"}
APPROACH_LABELS = {"risk_based": "リスクベース", "sectoral": "分野別", "soft_law": "ソフトロー"}
DIFF_LABELS = {"stricter": "EUより厳しい", "looser": "EUより緩い", "absent": "規定なし", "unique": "独自規定"}
CHANGE_TYPE_LABELS = {"new_regulation": "新規制", "status_change": "ステータス変更", "guideline_draft": "ガイドライン案", "deadline_change": "期限変更", "diff_change": "差分変化", "other": "その他"}

# The words of which an article must hold one, as substrings without regard to case.
KEYWORDS = ["AI", "人工知能", "artificial intelligence", "regulation", "regulatory", "規制", "法", "法律", "act", "guideline", "guidance", "ガイドライン", "policy", "政策", "compliance", "施行", "罰則", "透明性", "リスク"]
# Phrases of pages that only ask for scripts or cookies.
BLOCKED_PHRASES = ["enable javascript", "please enable javascript", "cookie consent", "accept all cookies"]
# Placeholders, limits.
EMPTY_LIST, EMPTY_REPORT, EMPTY_SUMMARY = "該当なし", "なし", "—"

MIN_BODY_CHARS = 600
RECENCY_DAYS = 90
LIST_DAYS = 60
FIRST_RUN_DAYS = 3
MAX_LINKS = 20
MAX_PER_RUN = 8
LABEL_CHARS = 120
SNIPPET_CHARS = 300
BODY_CHARS = 20_000
