"""Fixed values. They must stay as they are for results to agree; no logic lives here."""

# Model features, in model order.
FEATURES = [
    "payment_discipline_score",
    "income_stability_index",
    "financial_resilience_score",
]

# Raw customer attributes, in table order.
RAW_ATTRIBUTES = [
    "monthly_income",
    "income_variance",
    "bill_payment_delay_avg",
    "missed_payments_6m",
    "spending_ratio",
    "savings_rate",
    "employment_duration_months",
    "account_age_months",
]

# Weights of the behaviour score (payment, income, resilience) and of the risk
# target (income, payment, resilience). The two orders differ on purpose.
BEHAVIOUR_WEIGHTS = {
    "payment_discipline_score": 0.4,
    "income_stability_index": 0.3,
    "financial_resilience_score": 0.3,
}
TARGET_WEIGHTS = {
    "income_stability_index": 0.4,
    "payment_discipline_score": 0.3,
    "financial_resilience_score": 0.3,
}

# Rule engine: attribute, comparison, bound, rule name, impact; in evaluation order.
RULES = [
    ("spending_ratio", ">", 0.8, "High spending ratio", 0.15),
    ("bill_payment_delay_avg", ">", 3.0, "Frequent payment delay", 0.20),
    ("missed_payments_6m", ">", 2.0, "Multiple missed payments", 0.25),
    ("income_variance", ">", 0.3, "Unstable income pattern", 0.15),
    ("savings_rate", ">", 0.2, "Strong savings behavior", -0.15),
    ("employment_duration_months", ">", 60.0, "Stable employment", -0.10),
    ("savings_rate", "<", 0.1, "Low savings behavior", 0.10),
]
RULE_FALLBACK = ("No significant behavioral risk detected", 0.0)

# Bands of a 0..1 score: band, colour, label.
BAND_LOW = ("Low", "#16a34a", "Düşük Risk")
BAND_MEDIUM = ("Medium", "#f59e0b", "Orta Risk")
BAND_HIGH = ("High", "#dc2626", "Yüksek Risk")
BAND_MISSING = ("UNKNOWN", "Veri Yok")

# Warnings of the scoring response.
WARN_MISSING = "Müşteri verisi eksik → model güvenilir değil"
WARN_RESILIENCE_NULL = "Financial resilience eksik (DB/feature pipeline sorunu)"
WARN_RESILIENCE_ZERO = "Model düşük risk tahmin ediyor ancak finansal dayanıklılık 0."
WARN_SIMPLE = "Model düşük risk verdi ancak finansal dayanıklılık kritik."

# Sentence of the dominant factor.
FACTOR_TEXT = {
    "payment_discipline_score": "Payment behavior is the dominant risk driver.",
    "income_stability_index": "Income stability strongly influences risk level.",
    "financial_resilience_score": "Financial resilience is a key risk determinant.",
}
FACTOR_TEXT_DEFAULT = "Risk is influenced by multiple behavioral factors."

# Feature texts: (text when below 40, text when above 70).
FEATURE_TEXT = {
    "payment_discipline_score": (
        "Ödeme disiplini düşük, bu durum riski artırır.",
        "Ödeme disiplini güçlü, bu durum riski azaltır.",
    ),
    "income_stability_index": (
        "Gelir istikrarı düşük, bu durum riski artırır.",
        "Gelir istikrarı yüksek, bu durum riski azaltır.",
    ),
    "financial_resilience_score": (
        "Finansal dayanıklılık düşük, bu durum riski artırır.",
        "Finansal dayanıklılık yüksek, bu durum riski azaltır.",
    ),
}
SUMMARY_RAISES = " riski artırmaktadır"
SUMMARY_LOWERS = " riski azaltmaktadır"
SUMMARY_BALANCED = "Risk seviyesi dengeli finansal davranışlara dayanmaktadır."
SUMMARY_FRAGILE = " Ancak finansal dayanıklılık zayıf olduğu için kırılganlık riski bulunmaktadır."

# Display names of the features.
DISPLAY_NAME = {
    "payment_discipline_score": "Ödeme disiplini",
    "income_stability_index": "Gelir istikrarı",
    "financial_resilience_score": "Finansal dayanıklılık",
}
DIRECTION_LOWERS = "riski azaltıyor"
DIRECTION_RAISES = "riski artırıyor"

# Customer sentence parts.
SENTENCE_PAYMENT = "ödeme disiplini düşük (%"
SENTENCE_RESILIENCE = "finansal dayanıklılık çok düşük (%"
SENTENCE_INCOME = "gelir istikrarı yüksek (%"
SENTENCE_PREFIX = "Bu müşteri için "
SENTENCE_SUFFIX = " olduğu için risk seviyesi etkilenmiştir."
SENTENCE_DEFAULT = "Müşteri dengeli finansal davranış sergilemektedir."

# Narrative sentences, in order of the cases of operators.explain.narrative.
NARRATIVE = [
    "Model düşük risk tahmini üretmiş olsa da finansal dayanıklılık kritik seviyededir. Bu durum müşterinin ani finansal şoklara karşı yüksek kırılganlık taşıdığını gösterir.",
    "Modelin güven seviyesi düşüktür. Sonuçlar dikkatle değerlendirilmelidir.",
    "Finansal dayanıklılık kritik seviyede. Bu durum müşterinin finansal şoklara karşı ciddi şekilde savunmasız olduğunu gösterir.",
    "Finansal dayanıklılık zayıf. Risk düşük görünse bile kırılganlık riski bulunmaktadır.",
    "Model orta seviyede güven ile tahmin üretmiştir. Bazı faktörler dikkat gerektirebilir.",
    "Model finansal davranışlara göre düşük risk seviyesini güvenilir şekilde belirlemiştir.",
]

# Range rules: feature, min, max, label, colour, impact, priority, action, description.
RANGE_RULES = [
    ("financial_resilience", 0.0, 0.2, "Kritik", "#7f1d1d", 0.1, "HIGH", "Acil durum fonu oluşturulmalı", "Finansal dayanıklılık çok zayıf."),
    ("financial_resilience", 0.2, 0.6, "Zayıf", "#dc2626", 0.05, "MEDIUM", "Tasarruf artırılmalı", "Finansal dayanıklılık düşük."),
    ("financial_resilience", 0.6, 1.01, "Güçlü", "#16a34a", 0.0, "LOW", None, "Finansal dayanıklılık güçlü."),
    ("payment_discipline", 0.0, 0.6, "Zayıf", "#dc2626", 0.08, "HIGH", "Borç ödeme planı oluşturulmalı", "Ödeme disiplini zayıf."),
    ("payment_discipline", 0.6, 0.8, "Orta", "#f59e0b", 0.04, "MEDIUM", "Ödemeler düzenli hale getirilmeli", "Ödeme disiplini orta."),
    ("payment_discipline", 0.8, 1.01, "Güçlü", "#16a34a", 0.0, "LOW", None, "Ödeme disiplini güçlü."),
    ("income_stability", 0.0, 0.6, "Dengesiz", "#dc2626", 0.08, "HIGH", "Ek gelir kaynakları araştırılmalı", "Gelir istikrarsız."),
    ("income_stability", 0.6, 0.8, "Orta", "#f59e0b", 0.04, "MEDIUM", "Gelir çeşitlendirilmeli", "Gelir orta seviyede."),
    ("income_stability", 0.8, 1.01, "Stabil", "#16a34a", 0.0, "LOW", None, "Gelir istikrarlı."),
]
# Insight and action texts of the range rules.
RANGE_INSIGHT = {
    "financial_resilience": (
        "Critical financial vulnerability: no buffer against shocks.",
        "Low financial resilience increases risk exposure.",
        "Financial resilience contributes to stability.",
    ),
    "income_stability": (
        "Income instability increases risk variability.",
        "Stable income improves predictability.",
    ),
    "payment_discipline": (
        "Weak payment discipline increases default risk.",
        "Strong payment discipline reduces risk.",
    ),
}
RANGE_ACTION_RESILIENCE = "Build emergency buffer"
RANGE_ACTION_PAYMENT = "Improve payment discipline"
RANGE_ACTION_TEXTS = (
    "Critical financial vulnerability detected.",
    "Late payments increase risk exposure.",
    "AI recommendation from rule engine.",
)
RANGE_NO_RULE = ("No rule defined", "Invalid numeric input", "No matching rule range")

# Survey answers and their points; each survey has its own map.
ANSWERS_UNDERSTOOD_FORM = {"Evet": 10.0, "Kısmen": 7.0, "Hayır": 3.0}
ANSWERS_DECISION_FORM = {"Evet": 10.0, "Emin Değilim": 5.0, "Hayır": 2.0}
ANSWERS_DECISION_COMBINED = {"Evet": 10.0, "Hayır": 5.0, "Emin Değilim": 7.0}
ANSWERS_UNDERSTOOD_TERMINAL = {"evet": 10.0, "kismen": 7.0, "hayir": 3.0}
ANSWERS_DECISION_TERMINAL = {"evet": 10.0, "hayir": 5.0, "emin_degilim": 7.0}
ANSWER_TERMINAL_DEFAULT = 5.0

# Survey measures and their weights in the final score.
SURVEY_WEIGHTS = {
    "understanding_score": 0.25,
    "trust_score": 0.25,
    "usability_score": 0.20,
    "decision_score": 0.15,
    "prediction_score": 0.15,
}
SURVEY_METRIC_NAMES = {
    "understanding_score": "Anlaşılabilirlik",
    "trust_score": "Model Güveni",
    "usability_score": "Kullanılabilirlik",
    "decision_score": "Karar Güveni",
    "prediction_score": "Tahmin Doğruluğu",
    "final": "Final AI Score",
}

# Privacy report: metric names in order.
PRIVACY_METRICS = [
    "Original Records",
    "Final Records",
    "Data Loss (%)",
    "Average Group Size",
    "Minimum Group Size",
    "Re-identification Risk (%)",
    "Distinct risk_score",
    "K value",
    "L value",
]
QUASI_IDENTIFIERS = ["age_group", "monthly_income", "spending_ratio", "account_age_months"]

# Versions and stamps written with predictions.
STAMP_API = "api_inference"
STAMP_BATCH = "batch_pipeline"
STAMP_TRIGGER = "ml_pipeline"
TRIGGER_MODEL = "v1"
TRIGGER_DATASET = "dataset_v1"
UNKNOWN_MODEL = "unknown_model"
EXPLANATION_METHOD = "Hybrid (Rule Engine + LIME + Feature Attribution)"
EXPLAIN_SUMMARY = "Risk mainly influenced by behavioral financial patterns."
