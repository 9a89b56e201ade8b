"""The jobs: one module per target table, plus the whole load."""
