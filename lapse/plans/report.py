"""The whole study over a profile table and a ledger: every output table.

``study_outputs`` returns name -> DataFrame.  With ``checkpoint`` it first writes
the clean ledger and the model table once, which all outputs read; building the
split, the encoder and the quantiles also runs jobs. ``write_outputs`` writes each one as parquet, the encoded
table partitioned by split (train / validation / test folders).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lapse.config import LABEL_COL, StudyWindow
from lapse.operators import cleaning as C
from lapse.operators import dataset as D
from lapse.operators import features as A
from lapse.operators import integrity as J
from lapse.operators import profiling as P
from lapse.operators import summaries as S
from lapse.plans.study import Study


def study_outputs(profile: DataFrame, ledger: DataFrame, econ: DataFrame, window: StudyWindow,
                  segment_order: Sequence[str], exclude: Sequence[str] = C.GROUP_B_COLS,
                  checkpoint: bool = True) -> dict[str, DataFrame]:
    profile_clean = C.exclude_columns(profile, exclude)
    s = Study(profile_clean, ledger, window, checkpoint=checkpoint)
    if checkpoint:
        s.stored()
    rfm_cols = ["recency_days", *window.freq_cols, window.value_col, A.change_col(window)]
    monthly = S.monthly_volume_econ(s.tx_clean, econ)
    out = {
        "source_summary": P.source_summary({"profile": profile, "ledger": ledger, "econ": econ}),
        "column_overview": P.column_overview(profile),
        "dtype_counts": P.dtype_counts(profile),
        "ledger_profile": P.ledger_profile(ledger),
        "ledger_types": P.ledger_types(ledger),
        "missing_audit": P.missing_audit(profile),
        "structural_missing_check": P.structural_missing_check(profile),
        "segment_summary": P.segment_summary(profile, segment_order),
        "correlation_matrix": P.correlation_matrix(profile),
        "correlation_top_pairs": P.correlation_pairs(profile, largest=True),
        "correlation_bottom_pairs": P.correlation_pairs(profile, largest=False),
        "exclusion_report": C.exclusion_report(profile, exclude),
        "dedup_stats": C.dedup_stats(ledger),
        # min / max / distinct days and distinct keys cannot change under dedup
        "date_coverage": C.date_coverage(ledger),
        "empty_days": C.empty_days(ledger),
        "monthly_counts": C.monthly_counts(s.tx_clean),
        "window_counts": A.window_counts(s.tx_clean, window),
        "referential_integrity": J.referential_integrity(profile_clean, ledger),
        "rfm_features": s.rfm,
        "feature_stats": A.feature_stats(s.rfm, rfm_cols),
        "inactivity_label": s.label,
        "label_distribution": D.label_distribution(s.label),
        "model_dataset": s.model,
        "split_sizes": D.split_sizes(s.split),
        "encoder_classes": s.encoder,
        "encoder_unseen": s.unseen,
        "encoded_dataset": s.encoded,
        "segment_share": S.segment_share(profile, segment_order),
        "describe_by_segment": S.describe_by(profile, segment_order),
        "boxplot_stats": S.boxplot_stats(profile, segment_order),
        "risk_correlation": P.correlation_lower(s.model, S.RISK_FEATURES, digits=2),
        "target_correlation": P.target_correlation(s.model, S.RISK_FEATURES, LABEL_COL),
        "recency_histogram": S.histogram_by(s.model, LABEL_COL, "recency_days", groups=(0, 1)),
        "recency_by_label": S.group_center(s.model, LABEL_COL, "recency_days"),
        "metric_means_by_segment": S.metric_means(profile, segment_order),
        "daily_volume": S.daily_volume(s.tx_clean),
        "monthly_volume_econ": monthly,
        "strongest_month": S.extreme_month(monthly),
    }
    return out


def write_outputs(outputs: dict[str, DataFrame], path: str, names: Sequence[str] | None = None) -> list[str]:
    written = []
    for name in names or outputs:
        w = outputs[name].write.mode("overwrite")
        if name == "encoded_dataset":
            w = w.partitionBy("split")
        w.parquet(f"{path.rstrip('/')}/{name}")
        written.append(name)
    return written
