from weir.plans.composer import Run, run_steps

__all__ = ["Run", "run_steps"]
