"""User-level jobs: the copy job (J1-J3, J5), the file pipeline (J4), and the
registered queries with their SQL oracles."""
