"""textmark: rate texts at scale with Spark.

Labelled texts in, a mark from 1 to 10 per text out.  Everything is a lazy
DataFrame plan; the caller supplies the ``SparkSession``.
"""

from textmark.plans.ensemble import mark_with_members, train_members
from textmark.plans.learners import LearnerSpec, TrainedMember, train
from textmark.plans.scoring import Scorer, fit_scorer, score_table, score_text
from textmark.streaming.scoring import score_stream

__all__ = [
    "LearnerSpec",
    "Scorer",
    "TrainedMember",
    "fit_scorer",
    "mark_with_members",
    "score_stream",
    "score_table",
    "score_text",
    "train",
    "train_members",
]
