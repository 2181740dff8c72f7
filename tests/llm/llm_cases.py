"""Values that several tests of this folder share."""

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"

# texts with every awkward case: null, empty, blank, short, repeated, very long, no letters, other scripts
TEXTS = [
    None, "", "   \n\t ", "one", "One", "ONE ", "a b", "the quick brown fox jumps over the lazy dog and runs away from it",
    "The quick brown fox jumps over the lazy dog and runs away from it", "12 34 -- !!", "Ünïcode ß ﬃ 漢字 😀", "x" * 5000,
    " ".join(f"w{i}" for i in range(3000)), "line one\nline two\nline three\nline four\nline five", "\n\n\n", "null\x00byte \x1c\x85\xa0 end",
]
