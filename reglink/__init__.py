"""reglink: load, profile and link registry tables on Spark.

Every operator is a function from DataFrames to a DataFrame built from native
Spark expressions, so Catalyst plans, prunes and pushes down the whole chain.
"""

from reglink.session import build_session, ensure_checkpoint_dir, staging_dir

__all__ = ["build_session", "ensure_checkpoint_dir", "staging_dir"]
