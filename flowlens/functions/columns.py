"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.schema import CONF_THRESHOLD, SUSPECT_LABEL

# The characters that count as outer whitespace of a label.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# The wording of a triage record.
TRIAGE_SUSPECT = "Unknown / Zero-Day Suspect"
TRIAGE_NORMAL = "Normal Traffic"
ACTION_NORMAL = "Traffic allowed. Routine background telemetry logged."
ACTION_KNOWN = ("Automated Mitigation Triggered: Flow auto-blocked as signature matches known "
                "%s profile.")
ACTION_CORROBORATED = ("Automated Mitigation Triggered: Classifier confidence (%.1f%%) and Anomaly "
                       "Detector corroboration confirmed malicious activity.")
ACTION_SUSPECT = ("Escalated to SOC Tier-2 Human Analyst: Classifier lacks confidence or "
                  "statistical deviation detected (potential Zero-Day threat).")


def ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def rate(condition: Column, among: Column) -> Column:
    """Aggregate: share of the rows of ``among`` that meet ``condition``; NaN without rows."""
    return F.coalesce(F.avg(F.when(among, condition.cast("double"))), F.lit(float("nan")))


def clean_label(label: Column) -> Column:
    """Strip outer whitespace first, then trailing dots. A missing label reads ``nan``."""
    text = F.coalesce(label, F.lit("nan"))
    return F.rtrim(F.btrim(text, F.lit(WHITESPACE)), F.lit("."))


def binary_label(category: Column, normal: str = "Normal") -> Column:
    return (category != normal).cast("int")


def binary_text(label: Column) -> Column:
    return F.when(label == 1, "Attack").otherwise("Normal")


def final_label(pred_class: Column, conf: Column, anomalous: Column,
                conf_threshold: float = CONF_THRESHOLD) -> Column:
    """Four routing branches, tried in this order."""
    confident = conf >= conf_threshold
    return (F.when((pred_class == "Normal") & ~anomalous, F.lit("Normal"))
             .when(confident & ~anomalous, pred_class)
             .when(confident & anomalous & (pred_class != "Normal"), pred_class)
             .otherwise(F.lit(SUSPECT_LABEL)))


def routed_to(final: Column) -> Column:
    return (F.when(final == SUSPECT_LABEL, SUSPECT_LABEL)
             .when(final == "Normal", "Normal")
             .otherwise("Known Attack Class"))


def truth_group(is_novel: Column, label: Column) -> Column:
    return (F.when(is_novel == 1, "True Zero-Day Attack")
             .when(label == 1, "Known Attack")
             .otherwise("Normal"))


def triage(pred_class: Column, conf: Column, anomalous: Column,
           conf_threshold: float = CONF_THRESHOLD) -> Column:
    """Struct ``decision, badge, action`` for the analyst queue."""
    def record(decision, badge, action):
        return F.struct(decision.alias("decision"), F.lit(badge).alias("badge"),
                        action.alias("action"))

    confident = conf >= conf_threshold
    known = record(F.concat(F.lit("Known Attack: "), pred_class), "danger",
                   F.format_string(ACTION_KNOWN, pred_class))
    corroborated = record(F.concat(F.lit("Corroborated Attack: "), pred_class), "danger",
                          F.format_string(ACTION_CORROBORATED, conf * 100))
    return (F.when((pred_class == "Normal") & ~anomalous,
                   record(F.lit(TRIAGE_NORMAL), "success", F.lit(ACTION_NORMAL)))
             .when(confident & ~anomalous, known)
             .when(confident & anomalous & (pred_class != "Normal"), corroborated)
             .otherwise(record(F.lit(TRIAGE_SUSPECT), "warning", F.lit(ACTION_SUSPECT))))


def clean_feature_name(raw: Column, nominal: list[str]) -> Column:
    """``num__x`` -> ``x`` and ``cat__service_http`` -> ``service=http``."""
    names = "|".join(nominal)
    name = F.regexp_replace(raw, "^num__", "")
    name = F.regexp_replace(name, f"^cat__({names})_", "$1=")
    return F.regexp_replace(name, "^cat__", "")


def argmax_index(values: Column) -> Column:
    """0-based position of the largest element; the first one wins on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
