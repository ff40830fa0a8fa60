"""Static clouds have no streaming semantics of their own. Every kernel is a stateless column expression and so works
on streaming DataFrames as it is; decode() in splatframe.plans.cloud does, too."""
