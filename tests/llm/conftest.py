import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
