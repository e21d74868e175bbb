"""reviewlens: a Spark-native text-classification analytics engine.

Raw reviews go through scan -> canonical columns -> null policy -> native text
cleaning -> labels -> profiling -> exact samples and splits -> features ->
MLlib learners -> evaluation, every step a DataFrame plan.
"""

from reviewlens.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
