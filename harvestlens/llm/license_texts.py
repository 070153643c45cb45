"""Openings and notices of public licences, their labels and the phrases that must stand in each."""

#: label, text, mandatory key phrases.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ["permission is hereby granted free of charge", "without restriction"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Licensed under the MIT License", ["mit license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at", ["apache license version 2 0"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ["general public license version 3"]),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ["general public license version 2"]),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version", ["gnu general public license", "free software foundation"]),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ["lesser general public license"]),
    ("agpl-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", ["affero general public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", ["redistribution and use in source and binary forms"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ["permission to use copy modify", "with or without fee"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", ["mozilla public license v 2 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright and related or neighboring rights"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("proprietary", "All rights reserved. Unauthorized copying of this file, via any medium is strictly prohibited", ["unauthorized copying", "strictly prohibited"]),
]

#: Base phrases and their labels.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
