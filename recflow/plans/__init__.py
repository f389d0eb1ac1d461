"""Join/rank building blocks, the registered queries and their SQL oracle."""
