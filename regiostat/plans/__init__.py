"""Views, report sheets and dashboard datasets as pure functions of a ``TableSet``."""
