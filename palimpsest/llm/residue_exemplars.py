"""Labelled exemplars for residue (problem 4): messages of common servers, browsers, site builders and templates, and, as
kind `policy`, sentences of policies that merely speak of the same things. They are written from what such software says in
general and owe nothing to any table the operator runs over.
"""

from __future__ import annotations

# Words of the customary mock Latin that are rare in other languages.
FILLER_SEEDS = frozenset(
    "lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua enim veniam quis nostrud exercitation ullamco laboris nisi "
    "aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim laborum".split()
)

#: Words that tell an unfilled place between brackets from other words there.
CUES = frozenset("insert enter fill in your here to be added completed inserted confirmed decided tbd tbc placeholder name einfügen eintragen ihr hier insérer votre ici insertar su aquí".split())

_BY_KIND = {
    "place": """
{{ name }}
{% name %}
<% name %>
${name}
{name}
[[name]]
[...]
«NAME»
%%NAME%%
@@NAME@@
__NAME__
[insert name]
[insert company]
[insert]
[enter company]
[fill in]
[fill in company]
[your name]
[your company]
[your company name]
[your company here]
[your name here]
[company name]
[name]
[name of company]
[company here]
[company to be confirmed]
[company to be added]
[company to be completed]
[company to be inserted]
[company to be decided]
[to be confirmed]
[to be added]
[to be completed]
[to be inserted]
[tbd]
[tbc]
[placeholder]
<insert name>
<insert company>
<enter company>
<your name>
<your company>
<your company name>
<your company here>
<company name>
<company here>
[einfügen]
[Firma einfügen]
[Firma eintragen]
[Ihr Name]
[Ihr Unternehmen]
[insérer société]
[votre société]
[insertar empresa]
[su empresa]""",
    "filler": """
Lorem ipsum dolor
asdf asdf
asdf jkl
qwer qwer
qwerty qwerty
test test test
foo bar baz
blah blah blah
xxxx xxxx
This is a test
This is only a test
Sample text goes here
Example text goes here
Text goes here
Your text here
Your title here
Your content here
Add your text here
Add a heading
Add a caption
Add a description
Add a subtitle
Type your text here
Type something here
Enter your text here
Insert text here
Insert your content here
Write your content here
Click here to edit this text
Click to edit
Double click to edit
Click to add text
Replace this text with your own
Replace this paragraph with your own wording
This is placeholder text
This is dummy text
Dummy copy
Placeholder copy
For layout only
For placement only
For layout purposes only
Dummy text of the printing and typesetting industry
Placeholder paragraph
Filler text
Dummy block
Sample paragraph
Hello world! Welcome. This is your first post. Edit or delete it
Beispieltext hier einfügen
Blindtext
Texte factice
Votre texte ici
Texto de ejemplo
Su texto aquí""",
    "draft": """
TODO: write this section
TODO: add text
TODO: fill in
TODO
FIXME
FIXME: fix this section
TBD
TBD to be determined
To be determined
To be completed
To be confirmed
TBD by the legal team
Awaiting text from legal
Legal wording pending
TODO: update this clause
Wording to be supplied
Replace before publishing
Draft
DRAFT do not publish
Draft for internal review only, do not publish
Draft version, not for publication
Internal draft, not for distribution
For internal review only
Coming soon
Content coming soon
Content to follow
This page is under construction
Section under construction
Note to editor: update this section
Entwurf, nicht veröffentlichen
Brouillon, ne pas publier
Borrador, no publicar""",
    "error": """
Error 500 Internal Server Error
HTTP/1.1 500 Internal Server Error
HTTP Error 503. The service is unavailable.
502 Bad Gateway nginx
503 Service Unavailable
503 Service Temporarily Unavailable
504 Gateway Timeout
Gateway timeout after 30 seconds
429 Too Many Requests
Too many requests. Please retry later.
Too many requests, slow down
Please retry in 30 seconds
400 Bad Request
401 Unauthorized
404 Not Found
Error 404: page not found
404 Page not found
Page not found
410 Gone
The page you are looking for does not exist
The page you requested could not be found
The page you are looking for could not be found on this server
We can't find the page you're looking for
We cannot seem to find this page
Sorry, this page does not exist
This page has moved or no longer exists
This page is no longer available
Oops! That page can't be found
The requested URL was not found on this server
File not found
Go back to the home page or try a search
Nothing to see here
This page could not be displayed
The server encountered an internal error and was unable to complete your request
Please try again in a few minutes
Sorry, something went wrong. Please try again later.
Something went wrong on our end
Oops, something went wrong
An error occurred while processing your request
An unexpected error has occurred
There was a problem loading this page
Fatal error: uncaught exception on line 12
Cannot connect to the database
Error establishing a database connection
Warning: undefined variable on line 12
Undefined index on line 12
Uncaught exception
Stack trace
Traceback (most recent call last)
Exception in thread main
NullPointerException
NullReferenceException: Object reference not set
Object reference not set to an instance of an object
Cannot read properties of undefined
Segmentation fault
The request timed out
The connection has timed out
The server took too long to respond
Your session has expired. Please log in again to continue.
Session timed out. Sign in again.
Seite nicht gefunden
Die angeforderte Seite wurde nicht gefunden
Ein Fehler ist aufgetreten
Interner Serverfehler
Page introuvable
Page non trouvée
La page demandée n'existe pas
Une erreur est survenue
Une erreur s'est produite
Erreur interne du serveur
Página no encontrada
La página solicitada no existe
Se ha producido un error
Error interno del servidor""",
    "block": """
403 Forbidden
HTTP/1.1 403 Forbidden
Access denied
Access to this page has been denied
You do not have permission to access this page on this server
You do not have permission to view this page
You are not authorised to access this resource
You are not authorized to view this page
Your access to this site has been blocked
Your request has been blocked by our security service
Your IP address has been blocked. Reference ID 12
Sorry, you have been blocked
Please verify you are human
Verify that you are human to continue
Please complete the captcha to continue
Confirm that you are not a robot
Verifying you are human. This may take a few seconds.
Unusual traffic from your network has been detected
Checking your browser before accessing the site
Checking your browser. This takes up to 5 seconds.
Checking if the site connection is secure
Just a moment
Please wait while we verify your browser
Ray ID 12
Incident ID 12
Zugriff verweigert
Der Zugriff auf diese Seite wurde gesperrt
Accès refusé
Acceso denegado""",
    "maintenance": """
The site is down for maintenance
We are down for scheduled maintenance. We will be back soon.
Our servers are currently undergoing maintenance. Please try again shortly.
We will be back soon
This service is temporarily unavailable due to maintenance
Site under maintenance. Please check back soon.
The website is currently offline
Wegen Wartungsarbeiten ist diese Seite nicht erreichbar
Diese Seite ist vorübergehend nicht erreichbar
Site en maintenance
Le site est en cours de maintenance
El sitio está en mantenimiento
Estamos realizando tareas de mantenimiento""",
    "script": """
Please enable JavaScript to view this page
Please turn on JavaScript in your browser and reload
You need to enable JavaScript to run this app
JavaScript is disabled in your browser
JavaScript is disabled. Activate it to continue reading.
JavaScript is required to use this site
This site requires JavaScript to be enabled
This site requires scripts. Turn them on in your browser and reload the page.
This page needs scripts to display its content
Your browser does not support scripts or has them switched off
The document cannot be shown
Content is unavailable without JavaScript
Enable scripts to continue
Allow scripts for this site
Loading, please wait
If nothing happens, click here
This application requires JavaScript
It looks like JavaScript is turned off in your browser
Scripts must be enabled to see this page
noscript
Enable JavaScript and cookies to continue
Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen
JavaScript ist in Ihrem Browser deaktiviert
Ihr Browser unterstützt kein JavaScript
Veuillez activer JavaScript pour afficher cette page
JavaScript est désactivé dans votre navigateur
Active JavaScript para ver esta página
Es necesario activar JavaScript para usar este sitio
Habilite JavaScript en su navegador para continuar""",
    "policy": """
Our website uses JavaScript to measure visits
Our pages use scripts to set cookies
We use scripts and cookies to improve our services
You can disable JavaScript in the settings of your browser
If an error occurs we will notify you
If an error appears in the service, we store a log
If a page is not found, the visit is not counted
Access is denied to users who breach these terms
We may deny or block access to the service
You will be denied access to the account after three attempts
We may contact you if the service is unavailable
The service may be unavailable during maintenance
Maintenance is carried out every month
Your session expires after 30 minutes
Sessions expire after 30 days
A draft of the contract will be sent to you
Drafts are kept for 30 days
Sample texts are sent on request
Test accounts are deleted after 30 days
Terms in [brackets] are explained in the annex
The symbol [n] refers to note n
Requests are limited to 12 per second
Too many requests may lead to a suspension of your account
You may be asked to verify your identity
Your reference number is shown on the invoice
A value that is undefined is set to null
If a page is missing or cannot be found, tell our support
A to do list may hold up to 12 entries""",
}

EXEMPLARS: list[tuple[str, str]] = [(kind, line) for kind, block in _BY_KIND.items() for line in block.split("\n") if line]
