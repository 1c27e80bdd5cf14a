"""The four analytics chains, each step a lazy DataFrame."""
