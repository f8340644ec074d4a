"""The study as one lazy plan:

    ledger -> dedup -> {rfm_features, inactivity_label} -> model_dataset
           -> ordered_split -> zero_fill -> encoder (fit on train) -> encoded

The features, the label and the model are lazy plans.  The split, the encoder
and the encoded table run jobs while they are built: boundary rows and class
positions come from tables written on the way.  Heavy shared inputs (the deduped
ledger, the model table) appear several times in the plan; Spark reuses
identical exchanges.  With ``checkpoint`` (the default) the model table is
written once to the session's checkpoint dir before its several consumers read it: the lineage is cut (a lost executor re-reads
the written table) and the plans stay small.  ``stored`` writes the clean
ledger and the model as parquet for studies with many outputs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapse.config import KEY_COL, LABEL_COL, StudyWindow
from lapse.functions.materialize import freeze
from lapse.operators.cleaning import FILL_ZERO_COLS, dedup_exact, zero_fill
from lapse.operators.dataset import CAT_COLS, apply_encoder, fit_encoder, model_dataset, ordered_split, unseen_counts
from lapse.operators.features import inactivity_label, rfm_features, rfm_with_label
from lapse.session import scratch_folder


class Study:
    def __init__(self, profile: DataFrame, ledger: DataFrame, window: StudyWindow,
                 exclude: Sequence[str] = (), key: str = KEY_COL, label: str = LABEL_COL,
                 cat_cols: Sequence[str] = CAT_COLS, fill_zero: Sequence[str] = FILL_ZERO_COLS,
                 dedup: bool = True, checkpoint: bool = True):
        self.profile = profile
        self.ledger = ledger
        self.window = window
        self.exclude = list(exclude)
        self.key = key
        self.label_col = label
        self.cat_cols = list(cat_cols)
        self.fill_zero = list(fill_zero)
        self.dedup = dedup
        self.checkpoint = checkpoint
        self._stored = False

    def stored(self) -> "Study":
        """Write the clean ledger and the model once, as parquet in the session's shared checkpoint folder.

        Every later output reads only the columns it needs of them, instead of
        repeating the ledger's dedup shuffle and the model's aggregation and join.
        """
        spark = self.ledger.sparkSession
        folder = scratch_folder(spark, "study")
        for name in ("tx_clean", "model"):  # the model is computed from the written ledger
            getattr(self, name).write.parquet(f"{folder}/{name}")
            setattr(self, name, spark.read.parquet(f"{folder}/{name}"))
        self._stored = True
        return self

    @cached_property
    def tx_clean(self) -> DataFrame:
        return dedup_exact(self.ledger) if self.dedup else self.ledger

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm_features(self.tx_clean, self.window, key=self.key)

    @cached_property
    def label(self) -> DataFrame:
        # presence flags (max) cannot change with duplicates: no dedup needed
        return inactivity_label(self.ledger, self.window, key=self.key, label=self.label_col)

    @cached_property
    def model(self) -> DataFrame:
        """Lazy model table (for single-use summaries)."""
        feats = rfm_with_label(self.tx_clean, self.window, key=self.key, label=self.label_col)
        return model_dataset(self.profile, feats, key=self.key, exclude=self.exclude)

    def _freeze(self, df: DataFrame) -> DataFrame:
        return freeze(df) if self.checkpoint else df

    @cached_property
    def split(self) -> DataFrame:
        """The split reads the model for its size, its keys and its rows, so with ``checkpoint`` the model is written
        once.  The split itself is a comparison with two rows: its readers repeat it instead of writing it."""
        model = self.model if self._stored else self._freeze(self.model)
        return ordered_split(model, order_col="recency_days", tie_col=self.key)

    @cached_property
    def encoder(self) -> DataFrame:
        return fit_encoder(self.split.filter(F.col("split") == "train"), self.cat_cols)

    @cached_property
    def encoded(self) -> DataFrame:
        filled = zero_fill(self.split, self.fill_zero)
        return apply_encoder(filled, self.encoder, self.cat_cols, checked_broadcast=self.checkpoint, frozen=True)

    @cached_property
    def unseen(self) -> DataFrame:
        """Values of the rows held out of training that the encoder never saw, per encoded column."""
        return unseen_counts(self.split.filter(F.col("split") != "train"), self.encoder, self.cat_cols, frozen=True)
