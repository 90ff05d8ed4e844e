"""Stop words of the registered runs: frequent short words of the four languages of ``documents``.

The operators take the list as a parameter; a run on real text passes the whole list of its language
(``sources.readers.read_wordlist``), or a table of it (``operators.text.remove_stopwords_table``).
"""

STOPWORDS = tuple(
    """a an and as at be by for from he her his in is it not of on or that the there this to was were which with
au avec dans de des du elle en est et il la le les ne pas par pour qui que se sur un une
als auf aus das dem den der die ein eine ist mit nicht sich und von werden zu
como con del el en es la las lo los no para por que se su una y""".split()
)
