from shelfdiff.plans import q_diff, q_functions, q_gate, q_publish, q_tables  # noqa: F401
