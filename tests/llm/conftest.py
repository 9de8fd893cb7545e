import os

# tests name the vocabulary folder of the box unless one is given
os.environ.setdefault("PIXLOOM_TOKENIZERS", "/opt/tokenizers")
