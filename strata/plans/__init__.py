"""The composed jobs: enrollment, programs, epidemic, ledger, properties, attendance."""
