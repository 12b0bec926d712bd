"""Training-data operators; each module holds one operator and works on any DataFrame with an id and a text."""
